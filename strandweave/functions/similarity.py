"""Similarity of strings and token sets.

Set measures, the character multiset ratio and the n-gram cosine are column expressions, and so are the
token arrays of the two token ratios. What is left to one vectorised Python function are Jaro-Winkler and
the sequence ratio, for which Spark has no built-in.
"""

from __future__ import annotations

import math
from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import SPACE, pieces


def _bare(text: Column) -> Column:
    return F.regexp_replace(text, rf"[{SPACE}]+", "")


def grams(text: Column, n: int = 3) -> Column:
    """All n-character windows of the text without white space; a shorter text is its own only one."""
    bare = _bare(text)
    windows = F.transform(F.sequence(F.lit(1), F.greatest(F.length(bare) - n + 1, F.lit(1))), lambda i: F.substr(bare, i, F.lit(n)))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(windows)


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if one is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.coalesce(F.try_divide(both, F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_union(a, b)))), F.lit(0.0))


def overlap_coefficient(a: Column, b: Column) -> Column:
    """Shared members over the smaller set; 0 if one is empty."""
    least = F.least(F.size(F.array_distinct(a)), F.size(F.array_distinct(b)))
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), least), F.lit(0.0))


def _guarded(a: Column, b: Column, value: Column) -> Column:
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).otherwise(value)


def char_ratio(a: Column, b: Column) -> Column:
    """Twice the shared characters, repeats counted, over the characters of both."""
    count = lambda s, c: F.length(s) - F.length(F.replace(s, c, F.lit("")))
    shared = F.aggregate(F.array_distinct(F.split(a, "")), F.lit(0), lambda n, c: n + F.when(c == "", 0).otherwise(F.least(count(a, c), count(b, c))))
    return _guarded(a, b, F.try_divide(2.0 * shared, F.length(a) + F.length(b)))


def gram_cosine(a: Column, b: Column, n: int = 3) -> Column:
    """Cosine of the n-gram counts; texts shorter than n only match if equal without white space."""
    bare = _bare
    zero = F.lit(0).cast("long")
    start = F.struct(F.lit("").alias("g"), zero.alias("l"), zero.alias("r"), zero.alias("ll"), zero.alias("rr"), zero.alias("lr"))

    def step(s: Column, x: Column) -> Column:
        """Along the sorted grams of both: how many of this gram came before on either side. Each new one
        adds its like on the other side to the product, and twice its like plus one to its own square."""
        same = s["g"] == x["g"]
        l, r = F.when(same, s["l"]).otherwise(zero), F.when(same, s["r"]).otherwise(zero)
        left = x["side"] == 0
        return F.struct(
            x["g"].alias("g"),
            (l + F.when(left, 1).otherwise(0)).alias("l"),
            (r + F.when(left, 0).otherwise(1)).alias("r"),
            (s["ll"] + F.when(left, 2 * l + 1).otherwise(0)).alias("ll"),
            (s["rr"] + F.when(left, 0).otherwise(2 * r + 1)).alias("rr"),
            (s["lr"] + F.when(left, r).otherwise(l)).alias("lr"),
        )

    tagged = lambda x, side: F.transform(grams(x, n), lambda g: F.struct(g.alias("g"), F.lit(side).alias("side")))
    found = F.aggregate(F.array_sort(F.concat(tagged(a, 0), tagged(b, 1))), start, step, lambda s: F.try_divide(s["lr"], F.sqrt(s["ll"]) * F.sqrt(s["rr"])))
    short = (F.length(bare(a)) < n) | (F.length(bare(b)) < n)
    return _guarded(a, b, F.when(short, (bare(a) == bare(b)).cast("double")).otherwise(found))


def length_gap(a: Column, b: Column) -> Column:
    return F.abs(F.length(a) - F.length(b)) / F.greatest(F.length(a), F.length(b), F.lit(1))


def agreement(a: Column, b: Column) -> Column:
    """-1 if one is missing, else whether they are equal."""
    return F.when((a == "") | (b == ""), -1.0).otherwise((a == b).cast("double"))


def _equal_or_empty(a: str, b: str) -> float | None:
    if not a or not b:
        return 0.0
    return 1.0 if a == b else None


def _shared_order(a: str, b: str) -> tuple[list[str], list[str]]:
    """The matched characters of either string, in its own order. Each character of ``a`` takes the
    first free equal one of ``b`` within the window."""
    reach = max(len(a), len(b)) // 2 - 1
    free = dict(enumerate(b))
    left, taken = [], []
    for i, c in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(i + reach + 1, len(b))) if free.get(j) == c), None)
        if j is not None:
            del free[j]
            taken.append(j)
            left.append(c)
    return left, [b[j] for j in sorted(taken)]


def jaro_winkler(a: str, b: str, weight: float = 0.1, longest: int = 4) -> float:
    known = _equal_or_empty(a, b)
    if known is not None:
        return known
    left, right = _shared_order(a, b)
    m = len(left)
    if not m:
        return 0.0
    moved = sum(x != y for x, y in zip(left, right, strict=True)) / 2
    jaro = (m / len(a) + m / len(b) + (m - moved) / m) / 3.0
    prefix = next((i for i, (x, y) in enumerate(zip(a[:longest], b[:longest], strict=False)) if x != y), min(len(a), len(b), longest))
    return jaro + prefix * weight * (1.0 - jaro)


def sequence_ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def bare_cosine(a: str, b: str, n: int = 3) -> float:
    """:func:`gram_cosine` of two texts that have no white space."""
    if len(a) < n or len(b) < n:
        return float(a == b)
    left, right = (Counter(x[i : i + n] for i in range(len(x) - n + 1)) for x in (a, b))
    size = lambda c: math.sqrt(sum(k * k for k in c.values()))
    return sum(k * right[g] for g, k in left.items() if g in right) / (size(left) * size(right))


def _joined(tokens: Column) -> Column:
    return F.array_join(F.array_sort(tokens), " ")


def sorted_text(text: Column) -> Column:
    """The words in order, one space apart."""
    return _joined(pieces(text))


def token_set_texts(a: Column, b: Column) -> tuple[Column, Column, Column]:
    """The shared words in order, and those with the words of one side behind them."""
    x, y = F.array_distinct(pieces(a)), F.array_distinct(pieces(b))
    core = _joined(F.array_intersect(x, y))
    side = lambda u, v: F.btrim(F.concat(core, F.lit(" "), _joined(F.array_except(u, v))))
    return core, side(x, y), side(y, x)


#: Measures that need Python: by name, the kind and the column prefix of the texts.
SEQUENCE_FIELDS = ["name_jaro_winkler", "name_token_sort", "name_token_set", "addr_jaro_winkler", "addr_token_sort"]
#: The same as :func:`gram_cosine`, for those whose rows go to Python anyway.
COSINE_FIELDS = ["name_char3_cosine", "addr_char3_cosine"]


def _guard(a: pd.Series, b: pd.Series, measure) -> list[float]:
    return [k if (k := _equal_or_empty(x, y)) is not None else measure(i) for i, (x, y) in enumerate(zip(a, b, strict=True))]


@F.pandas_udf(T.StructType([T.StructField(f, T.DoubleType()) for f in SEQUENCE_FIELDS + COSINE_FIELDS]))
def _sequence_measures(n1: pd.Series, n2: pd.Series, a1: pd.Series, a2: pd.Series, sorts: pd.DataFrame, sets: pd.DataFrame, bare: pd.DataFrame) -> pd.DataFrame:
    """All sequence measures of a batch of pairs in one pass."""
    sort_ratio = lambda p: lambda i: sequence_ratio(sorts[f"{p}1"][i], sorts[f"{p}2"][i])

    cosine = lambda p: lambda i: bare_cosine(bare[f"{p}1"][i], bare[f"{p}2"][i])

    def set_ratio(i: int) -> float:
        core, left, right = (sets[c][i] for c in ("core", "left", "right"))
        # Without a shared word only the two sides are compared.
        return max(sequence_ratio(x, y) for x, y in ([(left, right), (core, left), (core, right)] if core else [(left, right)]))

    columns = [
        [jaro_winkler(x, y) for x, y in zip(n1, n2, strict=True)],
        _guard(n1, n2, sort_ratio("n")),
        _guard(n1, n2, set_ratio),
        [jaro_winkler(x, y) for x, y in zip(a1, a2, strict=True)],
        _guard(a1, a2, sort_ratio("a")),
        _guard(n1, n2, cosine("n")),
        _guard(a1, a2, cosine("a")),
    ]
    return pd.DataFrame(dict(zip(SEQUENCE_FIELDS + COSINE_FIELDS, columns, strict=True)))


def sequence_measures(n1: Column, n2: Column, a1: Column, a2: Column) -> Column:
    """A struct of ``SEQUENCE_FIELDS`` and ``COSINE_FIELDS`` for the names and addresses of a pair."""
    core, left, right = token_set_texts(n1, n2)
    sorts = F.struct(sorted_text(n1).alias("n1"), sorted_text(n2).alias("n2"), sorted_text(a1).alias("a1"), sorted_text(a2).alias("a2"))
    bare = F.struct(_bare(n1).alias("n1"), _bare(n2).alias("n2"), _bare(a1).alias("a1"), _bare(a2).alias("a2"))
    return _sequence_measures(n1, n2, a1, a2, sorts, F.struct(core.alias("core"), left.alias("left"), right.alias("right")), bare)
