"""Normalisation of business names and addresses as column expressions.

Texts of plain Latin characters are cleaned by built-in functions alone. Others take a vectorised
Python function for the Unicode decomposition, which gets nulls for the rows that don't need it.
"""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Words of legal forms, taken out of names.
LEGAL_SUFFIXES = [
    "private limited", "pvt ltd", "private", "limited", "pvt", "ltd",
    "corporation", "corp", "incorporated", "inc", "llc", "l.l.c",
    "company", "co", "enterprises", "enterprise", "group", "holdings",
    "services", "solutions", "international", "global", "industries", "industry",
    "partners", "associates", "centre", "center",
]
# Words without information, taken out of tokens.
GENERIC_WORDS = ["the", "and", "of", "in", "for", "at", "by", "a", "an", "&"]

#: Word and space characters as Python's patterns have them; Java's own classes are ASCII.
WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x1c-\x1f\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
EDGE_LEFT, EDGE_RIGHT = rf"(?<![{WORD}])", rf"(?![{WORD}])"
#: A word boundary where the neighbour inside the match may itself be a sign.
EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
NOT_WORD = rf"[^{WORD}{SPACE}]"
_WEB = rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+|\.com|\.org|\.in|\.net|\.fr"


@cache
def _latin_table() -> tuple[str, str, str]:
    """Accented Latin characters with a one-character base, the bases, and a pattern of all texts
    that these and ASCII make up."""
    source, base, plain = [], [], []
    for code in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00)]:
        c = chr(code)
        bare = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if len(bare) != 1 or len(c.lower()) != 1:
            continue
        if bare == c:
            plain.append(c)
        else:
            source.append(c)
            base.append(bare)
    # As ranges: a class of single characters would be tried one by one.
    codes = {ord(c) for c in source + plain}
    starts, ends = sorted(c for c in codes if c - 1 not in codes), sorted(c for c in codes if c + 1 not in codes)
    covered = "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in zip(starts, ends, strict=True))
    return "".join(source), "".join(base), rf"^[\t\n\x0b\f\r\x20-\x7e{covered}]*$"


def bare_lower(text: str | None) -> str:
    """Compatibility decomposition without combining marks, in lower case, stripped."""
    if not text:
        return ""
    parts = unicodedata.normalize("NFKD", text)
    return "".join(c for c in parts if not unicodedata.combining(c)).lower().strip()


@F.pandas_udf(T.StringType())
def _bare_lower_udf(texts: pd.Series) -> pd.Series:
    return texts.map(bare_lower, na_action="ignore")


def unicode_clean(text: Column) -> Column:
    source, base, covered = _latin_table()
    text = F.coalesce(text, F.lit(""))
    is_latin = text.rlike(covered)
    native = F.btrim(F.lower(F.translate(text, source, base)), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(is_latin, native).otherwise(_bare_lower_udf(F.when(~is_latin, text)))


def pieces(text: Column) -> Column:
    """Array of the strings between white space."""
    return F.array_remove(F.split(text, rf"[{SPACE}]+"), "")


def _in(token: Column, names: list[str]) -> Column:
    return token.isin(*names)


def name_words(cleaned: Column) -> Column:
    """Words of a cleaned name without web parts, signs and legal forms; stop words stay."""
    text = F.regexp_replace(cleaned, _WEB, " ")
    text = F.regexp_replace(text, r"[@#()\[\]{}]", " ")
    # The only legal form with signs; all others are whole words, and so are the parts of phrases.
    text = F.regexp_replace(text, rf"{EDGE_LEFT}l\.l\.c{EDGE_RIGHT}", " ")
    single = [s for s in LEGAL_SUFFIXES if " " not in s and "." not in s]
    return F.filter(pieces(F.regexp_replace(text, NOT_WORD, " ")), lambda t: ~_in(t, single))


def core_tokens(words: Column) -> Column:
    return F.filter(words, lambda t: ~_in(t, GENERIC_WORDS))


def _last(text: Column, pattern: str) -> Column:
    return F.try_element_at(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.lit(-1))


def postal_code(text: Column) -> Column:
    """The last six-digit code that doesn't begin with 0, else the last five-digit code, else ''."""
    six = _last(text, rf"{EDGE_LEFT}[1-9]\p{{Nd}}{{5}}{EDGE_RIGHT}")
    five = _last(text, rf"{EDGE_LEFT}\p{{Nd}}{{5}}{EDGE_RIGHT}")
    return F.coalesce(six, five, F.lit(""))


def street_key(text: Column) -> Column:
    """First number with the word behind it, without the number's leading zeros."""
    pattern = rf"{EDGE_LEFT}(\p{{Nd}}+)[{SPACE}]+([a-z]{{3,}}){EDGE_RIGHT}"
    number, word = F.regexp_extract(text, pattern, 1), F.regexp_extract(text, pattern, 2)
    return F.when(word == "", "").otherwise(F.concat(F.ltrim(number, F.lit("0")), F.lit("_"), word))


def plot_key(text: Column) -> Column:
    return F.regexp_extract(text, rf"{EDGE_LEFT}([0-9]+[-/][0-9a-z/-]+){EDGE}", 1)


def address_tokens(text: Column) -> Column:
    found = pieces(F.regexp_replace(text, NOT_WORD, " "))
    return F.filter(found, lambda t: (F.length(t) >= 3) & ~t.rlike(r"^\p{Nd}+$") & ~_in(t, GENERIC_WORDS))


NORMAL_COLUMNS = ["n_text", "n_tokens", "n_compact", "a_text", "a_postal", "a_num_word", "a_plot", "a_tokens", "country"]


def normalise(entities, keep: list[str]):
    """``keep`` and the normalised columns of entities with business_name, business_address, country."""
    t = entities.select(
        *keep,
        unicode_clean(F.col("business_name")).alias("_name"),
        unicode_clean(F.col("business_address")).alias("a_text"),
        unicode_clean(F.col("country")).alias("_country"),
    )
    t = t.withColumn("_words", name_words(F.col("_name")))
    t = t.withColumn("n_tokens", core_tokens(F.col("_words")))
    a = F.col("a_text")
    return t.select(
        *keep,
        F.array_join("_words", " ").alias("n_text"),
        "n_tokens",
        F.array_join("n_tokens", "").alias("n_compact"),
        "a_text",
        postal_code(a).alias("a_postal"),
        street_key(a).alias("a_num_word"),
        plot_key(a).alias("a_plot"),
        address_tokens(a).alias("a_tokens"),
        F.col("_country").alias("country"),
    )
