import random
from collections import Counter
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from strandweave.functions import similarity as S


def pairs():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("aab cé", k=rng.randint(0, 12)))
    return [("ab", "ba"), ("tide", "diet"), ("diet", "tide"), ("", "x"), ("a b", "ab"), ("abc", "abc")] + [(word(), word()) for _ in range(300)]


def plain_grams(s):
    s = "".join(s.split())
    return {s[i : i + 3] for i in range(max(len(s) - 2, 1))} - {""}


def test_column_measures(spark):
    rows = [(i, a, b) for i, (a, b) in enumerate(pairs())]
    t = spark.createDataFrame(rows, "i int, a string, b string")
    a, b = F.col("a"), F.col("b")
    t = t.select("i", S.jaccard(S.grams(a), S.grams(b)).alias("j"), S.overlap_coefficient(S.grams(a), S.grams(b)).alias("o"), S.char_ratio(a, b).alias("r"), S.length_gap(a, b).alias("g"), S.agreement(a, b).alias("m"))
    for r in t.collect():
        x, y = rows[r.i][1:]
        p, q = plain_grams(x), plain_grams(y)
        assert abs(r.j - (len(p & q) / len(p | q) if p and q else 0)) < 1e-12
        assert abs(r.o - (len(p & q) / min(len(p), len(q)) if p and q else 0)) < 1e-12
        assert abs(r.r - (0 if not x or not y else 1 if x == y else SequenceMatcher(None, x, y).quick_ratio())) < 1e-12, (x, y)
        assert abs(r.g - abs(len(x) - len(y)) / max(len(x), len(y), 1)) < 1e-12
        assert r.m == (-1 if not x or not y else int(x == y))


def longest(a, b):
    """The longest common block: the first in a, then the first in b."""
    best = (0, 0, 0)
    for i in range(len(a)):
        for j in range(len(b)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            if n > best[0]:
                best = (n, i, j)
    return best


def plain_ratio(a, b):
    def matched(x, y):
        n, i, j = longest(x, y)
        return n and n + matched(x[:i], y[:j]) + matched(x[i + n :], y[j + n :])

    return 2 * matched(a, b) / (len(a) + len(b)) if a or b else 1.0


def plain_sort(a, b):
    if not a or not b or a == b:
        return float(bool(a) and a == b)
    return plain_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def plain_set(a, b):
    if not a or not b or a == b:
        return float(bool(a) and a == b)
    x, y = set(a.split()), set(b.split())
    shared = " ".join(sorted(x & y))
    left, right = ((shared + " " + " ".join(sorted(s))).strip() for s in (x - y, y - x))
    return max([plain_ratio(left, right)] + [plain_ratio(shared, s) for s in (left, right) if shared])


def plain_cosine(a, b):
    if not a or not b or a == b:
        return float(bool(a) and a == b)
    a, b = "".join(a.split()), "".join(b.split())
    if len(a) < 3 or len(b) < 3:
        return float(a == b)
    x, y = (Counter(s[i : i + 3] for i in range(len(s) - 2)) for s in (a, b))
    dot = sum(x[g] * y[g] for g in x)
    return dot / (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5


def test_known_values():
    assert S.jaro_winkler("", "a") == 0 and S.jaro_winkler("a", "a") == 1
    assert abs(S.jaro_winkler("martha", "marhta") - 0.9611111) < 1e-6
    assert abs(S.jaro_winkler("dwayne", "duane") - 0.84) < 1e-6
    assert S.sequence_ratio("tide", "diet") == 0.25 and S.sequence_ratio("diet", "tide") == 0.5
    assert plain_ratio("tide", "diet") == 0.25 and plain_ratio("diet", "tide") == 0.5
    assert all(-1e-9 <= S.jaro_winkler(a, b) <= 1 + 1e-9 for a, b in pairs())


def test_sequence_measures_and_cosine(spark):
    more = [("b a", "a b"), ("a b", "a b c"), ("ab", "a b"), ("ab", "cd"), ("abcd", "xyzw"), ("a  b", "a b"), ("abcabcabc", "abcabc x"), (" ", "a")]
    rows = [(i, a, b) for i, (a, b) in enumerate(pairs() + more)]
    t = spark.createDataFrame(rows, "i int, a string, b string")
    a, b = F.col("a"), F.col("b")
    for r in t.select("i", S.sequence_measures(a, b, a, b).alias("s"), S.gram_cosine(a, b).alias("c")).collect():
        x, y = rows[r.i][1:]
        assert abs(r.s.name_token_sort - plain_sort(x, y)) < 1e-12 and r.s.addr_token_sort == r.s.name_token_sort, (x, y)
        assert abs(r.s.name_token_set - plain_set(x, y)) < 1e-12, (x, y)
        assert r.s.name_jaro_winkler == r.s.addr_jaro_winkler == S.jaro_winkler(x, y)
        assert abs(r.c - plain_cosine(x, y)) < 1e-12, (x, y)


def test_cosine_in_python_is_the_expression(spark):
    texts = ["", "a", "ab c", "aaaa aaa", "new york street 10001", "york street 10001 new", "\u00e9t\u00e9 \U0001f600\U0001f600 x", "000 000 1", "ab\u00a0c"]
    t = spark.createDataFrame([(a, b) for a in texts for b in texts], "a string, b string")
    t = t.select(S.gram_cosine(F.col("a"), F.col("b")).alias("want"), S.sequence_measures(F.col("a"), F.col("b"), F.col("b"), F.col("a")).alias("s"))
    assert all(r.want == r.s.name_char3_cosine == pytest.approx(r.s.addr_char3_cosine, abs=1e-15) for r in t.collect())
