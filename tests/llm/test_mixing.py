from pyspark.sql import functions as F

from strandweave.llm import mixing, queries
from tests.oracle import assert_same

from .data import edge_docs, no_docs


def brute_targets(sizes, budget=1.5, cap=2):
    """Share by weight, stop at the caps, share the rest again until none is above."""
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, fixed = budget * sum(sizes.values()), {}
    while True:
        rest = [s for s in sizes if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weights[s] / sum(weights[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


def check(report):
    rows = report.collect()
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert r.taken in (0, r.size, 2 * r.size)
    want = brute_targets(sizes)
    for s in sizes:
        assert abs(target[s] - want[s]) <= 1e-6 * max(1, want[s])
        # Off by no more than the document in which the budget ends.
        assert abs(taken[s] - target[s]) <= max(r.size for r in rows if r.source == s)
    return rows


def test_query(spark, small):
    assert_same(queries.op3_mix_sources(spark, small), mixing.ORACLE_SQL, small)
    check(queries.op3_mix_sources(spark, small))


def test_hot_and_tiny_sources(spark):
    words = F.array_join(F.array_repeat(F.lit("w"), (F.col("id") % 37).cast("int")), " ")
    source = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 40, F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).otherwise(F.when(F.col("id") % 7 == 0, None).otherwise("z"))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), words.alias("text"), source.alias("source"))
    first = check(mixing.mix_report(docs))
    assert sorted(map(repr, first)) == sorted(map(repr, mixing.mix_report(docs.repartition(7)).collect()))
    # The mix itself holds each document as often as the report says.
    mixed = {r.doc_id: r["count"] for r in mixing.mix(docs).groupBy("doc_id").count().collect()}
    assert all(mixed.get(r.doc_id, 0) * r.size == r.taken for r in first)


def test_null_ids_and_repeats_come_near_the_target(spark):
    words = F.array_join(F.array_repeat(F.lit("w"), (F.col("id") % 50 + 1).cast("int")), " ")
    ids = F.when(F.col("id") % 2 == 0, None).otherwise(F.col("id"))
    docs = spark.range(4000).select(ids.alias("doc_id"), F.when(F.col("id") % 3 == 0, "one text that comes again and again").otherwise(words).alias("text"), F.concat(F.lit("s"), (F.col("id") % 4).cast("string")).alias("source"))
    rows = check(mixing.mix_report(docs))
    for s in ("s0", "s1", "s2", "s3"):
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 25.5
    mixed = mixing.mix(docs).groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("n")).collect()
    assert {r.source: r.n for r in mixed} == {s: sum(r.taken for r in rows if r.source == s) for s in {r.source for r in rows}}
    # A single group of exact copies.
    same = spark.range(1001).select(F.lit(5).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.when(F.col("id") < 600, "x").otherwise("y").alias("source"))
    rows = check(mixing.mix_report(same.repartition(5)))
    for s in "xy":
        assert abs(sum(r.taken for r in rows if r.source == s) - next(r.target for r in rows if r.source == s)) <= 1.5


def test_many_sources(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.concat(F.lit("s"), (F.col("id") * F.col("id") % 997).cast("string")).alias("source"))
    check(mixing.mix_report(docs))


def test_odd_rows(spark):
    rows = mixing.mix_report(edge_docs(spark)).collect()
    assert len(rows) == 16
    by = {r.doc_id: r for r in rows}
    assert by[1].size == by[2].size == by[3].size == 0 and by[3].target == 0
    assert mixing.mix_report(no_docs(spark)).count() == 0 and mixing.mix(no_docs(spark)).count() == 0
    only_blank = edge_docs(spark).filter("text is null or doc_id in (2, 3)")
    assert {r.taken for r in mixing.mix_report(only_blank).collect()} == {0}
