"""Mixing sources to target weights with hash-threshold histograms.

Targets: the sources, in code-point order with null last, weigh 3, 1, 2, repeating, and share
``budget`` times all words; a target stops at ``cap`` times its source's words and the excess is
shared among the rest by weight until none is above its cap.

Selection: every document has a 36-bit hash of its id and text, and a second one of 60 bits. A source
whose target is ``k`` times its words and a rest takes every document ``k`` times, and once more those
whose hash is below the source's threshold. The threshold is found from sums of words by source and hash
bucket: 4096 buckets of the upper 12 bits, then the boundary bucket alone by its next 12 bits, then by the
last 12, and the boundary cell by its documents. What is left there are rows of one id and text: as many
of them are taken as come nearest to the target. Nothing is sorted but the bucket sums of a source.

Scale: texts are read once; what is kept of them is id, source, size and hashes. The histograms are
pre-aggregated in each task, so a hot source costs no more than another, and neither do repeated rows:
those of the boundary are numbered within each partition, and only the partitions' counts are added up.
Sources are numbered within ranges, and their level is found by sums over all of them, so that their
number is not bounded by a task. The table of thresholds (one row a source) is counted and broadcast only
if its rows are few; otherwise the join is shuffled, and Spark splits its skewed keys.

Defined cases: null text has size 0; null source is a source of its own, the last; a null id hashes
as the empty string; very long texts are counted whole; rows of one id and text are taken one by one, so
that a source's words come within half a document of its target; a source of no words has target 0; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, small_or_shuffled, words

#: Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
BUDGET, CAP = 1.5, 2
#: Bits of each level of the histogram, from the top.
LEVELS = (12, 12, 12)
HASH_BITS = sum(LEVELS)


#: Hexadecimal digits of the second hash.
KEY_DIGITS = 15


def doc_hashes(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """36 bits of the md5 of id and text, and the next 60."""
    digest = F.md5(F.concat_ws("\x01", F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))).cast("binary"))
    digits = HASH_BITS // 4
    part = lambda at, n: F.conv(F.substring(digest, at, n), 16, 10).cast("long")
    return part(1, digits), part(digits + 1, KEY_DIGITS)


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``id, source, size, h, key`` of every document."""
    h, key = doc_hashes(F.col(id_col), F.col(text_col))
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        F.size(words(F.col(text_col))).cast("long").alias("size"),
        h.alias("h"),
        key.alias("key"),
    )


def _numbered(sources: DataFrame) -> DataFrame:
    """``place``: 0, 1, ... by code point, null last; numbered within ranges, whose sizes are added up."""
    order = F.col("source").asc_nulls_last()
    ranged = cut_lineage(sources.repartitionByRange(order).withColumn("_p", F.spark_partition_id()))
    counts = ranged.groupBy("_p").agg(F.count("*").alias("_n"))  # one row a range
    ahead = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_s"))
    within = F.row_number().over(Window.partitionBy("_p").orderBy(order)) - 1
    return ranged.withColumn("_i", within).join(ahead, "_p").withColumn("place", F.col("_i") + F.col("_s")).drop("_p", "_i", "_s")


def targets(sized: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """``source, source_size, target``; one row a source.

    The level is the target of weight 1. It rises as sources reach their cap and leave the rest of the
    budget to the others; each step is one sum over all sources, and it is found when none is added.
    """
    t = _numbered(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    t = cut_lineage(t.select("source", "source_size", w.alias("w"), (F.col("source_size") * F.lit(float(cap))).alias("full")))
    words_in_all, weight_in_all = t.agg(F.sum("source_size"), F.sum("w")).first()
    level, reached = None, -1
    while words_in_all is not None:
        capped = F.lit(False) if level is None else F.col("full") / F.col("w") <= F.lit(level)
        if_capped = lambda c, capped=capped: F.coalesce(F.sum(F.when(capped, F.col(c))), F.lit(0.0))
        n, full, weight = t.agg(F.count_if(capped), if_capped("full"), if_capped("w")).first()
        if n == reached or weight == weight_in_all:
            break
        reached, level = n, (words_in_all * float(budget) - full) / (weight_in_all - weight)
    target = F.least("full", F.col("w") * F.lit(0.0 if level is None else level))
    return t.select("source", "source_size", target.alias("target"))


def plan(sized: DataFrame, weights=WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """``source, source_size, target, base, threshold, edge, times, n``: every document ``base`` times, and
    once more those with a hash below ``threshold``, and in its cell those with a key below ``edge`` and
    ``times`` of the ``n`` that have it."""
    aims = targets(sized, weights, budget, cap)
    base = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    aims = cut_lineage(aims.withColumn("base", base.cast("long")))
    # The state of a source: words still to take, and the hash prefix below which all is taken.
    state = aims.select("source", (F.col("target") - F.col("base") * F.col("source_size")).alias("need"), F.lit(0).cast("long").alias("prefix"))
    low = HASH_BITS
    for bits in LEVELS:
        low -= bits
        rows = sized.withColumnRenamed("source", "s")
        cell = F.shiftright("h", low)
        if low + bits == HASH_BITS:
            inside = rows.select("s", cell.alias("cell"), "size")
        else:
            at = small_or_shuffled(state.select(F.col("source").alias("t"), "prefix"))
            inside = rows.join(at, F.col("s").eqNullSafe(F.col("t")) & (F.shiftright("h", low + bits) == F.col("prefix"))).select("s", cell.alias("cell"), "size")
        sums = inside.groupBy("s", "cell").agg(F.sum("size").alias("words"))
        upto = Window.partitionBy("s").orderBy("cell")
        sums = sums.withColumn("upto", F.sum("words").over(upto))
        joined = sums.join(state, F.col("s").eqNullSafe(F.col("source")))
        over = F.col("upto") > F.col("need")
        # The first cell that goes beyond the need is the boundary.
        first = joined.filter(over).groupBy("source").agg(F.min_by(F.struct("cell", "words", "upto"), "cell").alias("b"))
        first = first.withColumnRenamed("source", "t")
        left = F.col("need") - (F.col("b.upto") - F.col("b.words"))
        # Without a boundary the need is met by all cells, and the prefix is the one behind the last.
        state = cut_lineage(
            state.join(first, F.col("source").eqNullSafe(F.col("t")), "left").select(
                "source",
                F.when(F.col("b").isNull(), F.col("need")).otherwise(left).alias("need"),
                F.coalesce(F.col("b.cell"), F.lit(1 << (HASH_BITS - low)).cast("long")).alias("prefix"),
            )
        )
    # The documents of the boundary cell; those of one key are repeats.
    at = small_or_shuffled(state.withColumnRenamed("source", "t"))
    inside = sized.join(at, F.col("source").eqNullSafe(F.col("t")) & (F.col("h") == F.col("prefix")))
    keys = inside.groupBy("t", "key").agg(F.sum("size").alias("words"), F.count("*").alias("n"), F.max("need").alias("need"))
    keys = keys.withColumn("upto", F.sum("words").over(Window.partitionBy("t").orderBy("key")))
    some = F.floor(F.try_divide((F.col("need") - (F.col("upto") - F.col("words"))) * F.col("n"), F.col("words")) + 0.5).cast("long")
    edges = keys.filter(F.col("upto") > F.col("need")).groupBy("t").agg(F.min_by(F.struct("key", "n", some.alias("times")), "key").alias("e"))
    whole = lambda c, n: F.coalesce(c, F.lit(n).cast("long")).alias(c[2:])
    found = state.join(edges, F.col("source").eqNullSafe(F.col("t")), "left").select(
        F.col("source").alias("s"), F.col("prefix").alias("threshold"), whole("e.key", -1).alias("edge"), whole("e.times", 0), whole("e.n", 0)
    )
    return aims.join(found, F.col("source").eqNullSafe(F.col("s"))).drop("s")


def _taken(rows: DataFrame, aims: DataFrame) -> DataFrame:
    """``rows`` (with ``_s, _h, _key``) and, by source, the plan; ``_times``: how often the mix takes a row."""
    aims = cut_lineage(aims.withColumnRenamed("source", "_t"))
    joined = rows.withColumn("_p", F.spark_partition_id()).join(small_or_shuffled(aims), F.col("_s").eqNullSafe(F.col("_t")))
    cell, edge = F.col("_h") == F.col("threshold"), F.col("_key") == F.col("edge")
    sure = (F.col("_h") < F.col("threshold")) | (cell & (F.col("_key") < F.col("edge"))) | (cell & edge & (F.col("times") == F.col("n")))
    parted = (F.col("times") > 0) & (F.col("times") < F.col("n"))
    at = cell & edge & parted
    rest = joined.withColumn("_times", F.col("base") + sure.cast("long"))
    if aims.filter(parted).isEmpty():
        return rest
    # Repeats of which some are taken are numbered within their partition, and go on from those before it.
    repeats = joined.filter(at)
    counts = cut_lineage(repeats.groupBy("_t", "_p").agg(F.count("*").alias("_n")))
    before = Window.partitionBy("_t").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select(F.col("_t").alias("_u"), F.col("_p").alias("_q"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    number = F.row_number().over(Window.partitionBy("_t", "_p").orderBy("_key"))
    repeats = repeats.withColumn("_i", number).join(small_or_shuffled(cut_lineage(ahead)), F.col("_t").eqNullSafe(F.col("_u")) & (F.col("_p") == F.col("_q")))
    repeats = repeats.withColumn("_times", F.col("base") + (F.col("_i") + F.col("_ahead") <= F.col("times")).cast("long"))
    return rest.filter(~at).unionByName(repeats.select(*rest.columns))


def mix_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """``id_col, size, source_size, target, taken`` of every document."""
    sized = cut_lineage(sizes(docs, id_col, text_col, source_col))
    rows = sized.select("id", "size", F.col("source").alias("_s"), F.col("h").alias("_h"), F.col("key").alias("_key"))
    taken = F.col("size") * F.col("_times")
    return _taken(rows, plan(sized, **how)).select(F.col("id").alias(id_col), F.col("_s").alias("source"), "size", "source_size", "target", taken.alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The documents that the mix takes, each as often as it takes it, with their own columns."""
    aims = plan(cut_lineage(sizes(docs, id_col, text_col, source_col)), **how).select("source", "base", "threshold", "edge", "times", "n")
    h, key = doc_hashes(F.col(id_col), F.col(text_col))
    # Packed away, so that no column of theirs meets one of the plan's.
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(source_col).alias("_s"), h.alias("_h"), key.alias("_key"))
    times = F.array_repeat(F.lit(1), F.col("_times").cast("int"))
    return _taken(rows, aims).select("_doc", F.explode(times)).select("_doc.*")


#: The same result in DuckDB's SQL over the table documents.
ORACLE_SQL = """
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size,
    md5(coalesce(doc_id::varchar, '') || chr(1) || coalesce(text, '')) as digest,
    ('0x' || substr(digest, 1, 9))::bigint as h, ('0x' || substr(digest, 10, 15))::bigint as key
  from documents),
per_source as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (
  select *, [3.0::double, 1.0::double, 2.0::double][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as w,
    source_size * 2.0::double as "full",
    sum(source_size) over () * 1.5::double as budget from per_source),
leveled as (
  select *, sum(w) over () as all_w,
    (budget - coalesce(sum("full") over before, 0)) / (sum(w) over () - coalesce(sum(w) over before, 0)) >= "full" / w as capped
  from weighed
  window before as (order by "full" / w, source nulls last rows between unbounded preceding and 1 preceding)),
aims as (
  select source, source_size,
    case when capped then "full" else w * ((budget - sum(case when capped then "full" else 0 end) over ())
      / nullif(all_w - sum(case when capped then w else 0 end) over (), 0)) end as target
  from leveled),
needs as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end::bigint as base,
    target - (case when source_size > 0 then floor(target / source_size) else 0 end) * source_size as need from aims),
cells as (
  select source, h, key, sum(size) as words, count(*) as n, sum(sum(size)) over (partition by source order by h, key) as upto
  from sized group by source, h, key),
chosen as (
  select c.source, c.h, c.key, case when upto <= need then n when upto - words >= need then 0
    else floor((need - (upto - words)) * n / words + 0.5) end as times
  from cells c join needs n on c.source is not distinct from n.source),
numbered as (select *, row_number() over (partition by source, h, key) as i from sized)
select s.doc_id, s.source, s.size, n.source_size, n.target,
  (s.size * (n.base + case when i <= c.times then 1 else 0 end))::bigint as taken
from numbered s join needs n on s.source is not distinct from n.source
join chosen c on s.source is not distinct from c.source and s.h = c.h and s.key = c.key
"""
