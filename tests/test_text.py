"""Normalisation against expected values that were worked out by hand from the rules."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from strandweave.functions import text

# Name, text, tokens, compact key.
NAMES = [
    ("@primemoney", "primemoney", ["primemoney"], "primemoney"),
    ("Prime Money Inc.", "prime money", ["prime", "money"], "primemoney"),
    ("B\u00e1rbershop", "barbershop", ["barbershop"], "barbershop"),
    ("Ba\u0301rbershop", "barbershop", ["barbershop"], "barbershop"),
    # Parts of sites go wherever they are.
    ("foo.inc", "foo c", ["foo", "c"], "fooc"),
    ("acme.community", "acme munity", ["acme", "munity"], "acmemunity"),
    ("https://a.b/c d www.x y", "d y", ["d", "y"], "dy"),
    # Nothing but legal forms.
    ("Global Services Inc", "", [], ""),
    ("PVT  LTD", "", [], ""),
    ("private limited co", "", [], ""),
    # A legal form is a whole word, and an underscore is part of a word.
    ("inc_x inc", "inc_x", ["inc_x"], "inc_x"),
    ("incorporatedly", "incorporatedly", ["incorporatedly"], "incorporatedly"),
    ("x l.l.c", "x", ["x"], "x"),
    ("x l.l.c.", "x", ["x"], "x"),
    ("al.l.c", "al l c", ["al", "l", "c"], "allc"),
    # Signs part words; then the parts are looked at.
    ("co-op & sons", "op sons", ["op", "sons"], "opsons"),
    ("[Acme] (Labs) {x}#y", "acme labs x y", ["acme", "labs", "x", "y"], "acmelabsxy"),
    # Stop words stay in the text.
    ("The Bay of A", "the bay of a", ["bay"], "bay"),
    ("A.B.C. L.L.C. of the Bay", "a b c of the bay", ["b", "c", "bay"], "bcbay"),
    # Compatibility forms are taken apart; letters that have no base stay.
    ("\ufb01ne \u00bd \u2167", "fine 1 2 viii", ["fine", "1", "2", "viii"], "fine12viii"),
    ("\u0130stanbul Stra\u00dfe", "istanbul stra\u00dfe", ["istanbul", "stra\u00dfe"], "istanbulstra\u00dfe"),
    # Combining marks of no class stay, and part words as signs do.
    ("\u092d\u093e\u0930\u0924", "\u092d \u0930\u0924", ["\u092d", "\u0930\u0924"], "\u092d\u0930\u0924"),
    ("  x  ", "x", ["x"], "x"),
    ("a\tb\nc", "a b c", ["b", "c"], "bc"),
    ("\u00a0wide\u2003space\u3000", "wide space", ["wide", "space"], "widespace"),
    ("", "", [], ""),
    (None, "", [], ""),
]

# Address, text, postal code, street key, plot key, tokens.
ADDRESSES = [
    ("0017560 ELLIS RD", "0017560 ellis rd", "", "17560_ellis", "", ["ellis"]),
    ("1795 westchester", "1795 westchester", "", "1795_westchester", "", ["westchester"]),
    # A number of zeros leaves an empty one.
    ("000 main", "000 main", "", "_main", "", ["main"]),
    ("16-11-23/37/a", "16-11-23/37/a", "", "", "16-11-23/37/a", []),
    # A long code is a plot as well.
    ("12345-6789", "12345-6789", "12345", "", "12345-6789", []),
    # Six digits go before five; of several the last counts; a six-digit code doesn't begin with 0.
    ("123456 x 654321", "123456 x 654321", "654321", "", "", []),
    ("12345 x 012345 67890", "12345 x 012345 67890", "67890", "", "", []),
    ("12345 654321 99999", "12345 654321 99999", "654321", "", "", []),
    ("x12345 12345y 12345_", "x12345 12345y 12345_", "", "", "", ["x12345", "12345y", "12345_"]),
    # The street's word has three letters a to z at least and ends where they end.
    ("no 5th street 22 b 33 abc", "no 5th street 22 b 33 abc", "", "33_abc", "", ["5th", "street", "abc"]),
    ("12 abc\u00e9 9 def", "12 abce 9 def", "", "12_abce", "", ["abce", "def"]),
    ("12 abc\u00df 9 def", "12 abc\u00df 9 def", "", "9_def", "", ["abc\u00df", "def"]),
    # A plot ends at a word boundary: signs behind it are left out, an underscore is not a boundary.
    ("12-ab- c", "12-ab- c", "", "", "12-ab", []),
    ("12_abc 1/2_", "12_abc 1/2_", "", "", "", ["12_abc"]),
    ("66 edgewood the and 99 12a", "66 edgewood the and 99 12a", "", "66_edgewood", "", ["edgewood", "12a"]),
    ("\u0661\u0662 road 12345", "\u0661\u0662 road 12345", "12345", "\u0661\u0662_road", "", ["road"]),
    ("Main St., Main St.", "main st., main st.", "", "", "", ["main", "main"]),
    ("1 2 3", "1 2 3", "", "", "", []),
    ("", "", "", "", "", []),
    (None, "", "", "", "", []),
]


@pytest.fixture(scope="module")
def normal(spark):
    n = max(len(NAMES), len(ADDRESSES))
    rows = [(i, NAMES[i % len(NAMES)][0], ADDRESSES[i % len(ADDRESSES)][0], " C\u00f4te ") for i in range(n)]
    frame = spark.createDataFrame(rows, "row_id long, business_name string, business_address string, country string")
    return sorted(text.normalise(frame, ["row_id"]).collect(), key=lambda r: r.row_id)


def test_names(normal):
    for i, (name, *want) in enumerate(NAMES):
        assert [normal[i].n_text, normal[i].n_tokens, normal[i].n_compact] == want, name
        assert normal[i].country == "cote"


def test_addresses(normal):
    for i, (address, *want) in enumerate(ADDRESSES):
        r = normal[i]
        assert [r.a_text, r.a_postal, r.a_num_word, r.a_plot, r.a_tokens] == want, address


def test_every_latin_letter_is_cleaned_alike(spark):
    """Built-in functions and the Unicode decomposition agree on each character."""
    codes = [c for c in [*range(0x20, 0x250), *range(0x1E00, 0x1F00)] if unicodedata.category(chr(c)) != "Cn"]
    t = spark.createDataFrame([(c, f"a{chr(c)}b") for c in codes], "c int, x string")
    for r in t.select("c", "x", text.unicode_clean(F.col("x")).alias("got")).collect():
        assert r.got == text.bare_lower(r.x), hex(r.c)


def test_latin_texts_need_no_python(spark):
    t = spark.createDataFrame([("\u00dcn\u00efc\u00f6d\u00e9",)], "x string")
    covered = t.select(F.col("x").rlike(text._latin_table()[2])).first()[0]
    assert covered and t.select(text.unicode_clean(F.col("x"))).first()[0] == "unicode"
