"""The driver's tables in the shape of the three entity sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalise
from ..operators.blocking import candidate_pool
from ..operators.features import classes
from ..operators.metrics import labelled
from ..sources.scratch import cut_lineage

#: Structured entities from ``part``; the same text runs in DuckDB.
PARTS_SQL = """
select p_partkey as row_id,
 concat('S', cast(1 + p_partkey % 3 as varchar(20)), '-', cast(p_partkey as varchar(20))) as entity_id,
 case p_partkey % 3
   when 0 then concat(p_name, ' ', replace(p_brand,'#',' '), ' Pvt Ltd')
   when 1 then concat(upper(p_name), ' ', replace(p_brand,'#','-'), ' Inc.')
   else concat('@', replace(p_name,' ',''), ' ', replace(p_brand,'#',' '), ' LLC') end as business_name,
 concat(lpad(cast(p_size as varchar(20)),5,'0'), ' ', lower(p_type), ' street, ',
        cast(10000 + p_partkey % 40 as varchar(20)), ' near ', p_name,
        case when p_partkey % 4 = 1 then concat(' plot ', cast(p_partkey % 7 as varchar(20)), '-', cast(p_size % 5 as varchar(20)), '/a') else '' end) as business_address,
 case p_partkey % 5 when 0 then 'US' when 1 then 'India' when 2 then 'US' when 3 then 'India' else 'France' end as country,
 p_name, p_brand
from part"""

#: Free text entities from ``documents``: the whole text is the name, and the address.
DOCUMENTS_SQL = """
select doc_id as row_id,
 concat('S', cast(1 + doc_id % 3 as varchar(20)), '-', cast(doc_id as varchar(20))) as entity_id,
 text as business_name, text as business_address, lang as country
from documents"""

COLUMNS = ["row_id", "entity_id", "business_name", "business_address", "country"]


def entities(spark: SparkSession, sf_dir: str, sql: str = PARTS_SQL) -> DataFrame:
    table = "part" if sql is PARTS_SQL else "documents"
    query = sql.replace(f"from {table}", "from {t}").replace("varchar(20)", "string")
    return spark.sql(query, t=spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def source(rows: DataFrame, number: int) -> DataFrame:
    return rows.filter(F.startswith("entity_id", F.lit(f"S{number}-")))


def linked_sides(spark: SparkSession, sf_dir: str, sql: str = PARTS_SQL, foreign: bool = False) -> tuple[DataFrame, DataFrame]:
    """Normalised queries (source 1) and candidate pool (sources 2 and 3). With ``foreign`` the queries
    whose row id is divisible by 6 come from a country that the pool doesn't have."""
    rows = entities(spark, sf_dir, sql)
    queries = source(rows, 1)
    if foreign:
        queries = queries.withColumn("country", F.when(F.col("row_id") % 6 == 0, "Atlantis").otherwise(F.col("country")))
    pool = candidate_pool(source(rows, 2).select(*COLUMNS), source(rows, 3).select(*COLUMNS))
    # Blocking reads either side several times; normalising is the dear part. The sides are written once to
    # the checkpoint folder, which is emptied when nothing refers to them any more.
    return cut_lineage(normalise(queries, ["row_id", "entity_id"])), cut_lineage(normalise(pool, ["cand_idx", "entity_id"]))


def linked_kinds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """As :func:`linked_sides`, where entities of the same texts and country are normalised once: ids of the
    queries (row_id, entity_id, q_kind) and of the pool (cand_idx, entity_id, cand_kind), and the normalised
    texts of each kind of either side (row_id, cand_idx: those of its first entity)."""
    rows = entities(spark, sf_dir)
    texts = ["business_name", "business_address", "country"]
    out = []
    for side, key, kind in ((source(rows, 1), "row_id", "q_kind"), (candidate_pool(source(rows, 2), source(rows, 3)), "cand_idx", "cand_kind")):
        kinds = classes(side, texts, key, kind)
        first = side.join(kinds.filter(F.col(key) == F.col(kind)).select(key), key)
        out.append((side.select(key, "entity_id").join(kinds, key), cut_lineage(normalise(first, [key]))))
    (queries, q_texts), (pool, c_texts) = out
    return queries, pool, q_texts, c_texts


def part_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``s1_id, cand_id``: entities of one part name, brand and country."""
    rows = entities(spark, sf_dir)
    key = ["p_name", "p_brand", "country"]
    left = source(rows, 1).select(*key, F.col("entity_id").alias("s1_id"))
    right = rows.filter(~F.startswith("entity_id", F.lit("S1-"))).select(*key, F.col("entity_id").alias("cand_id"))
    return left.join(right, key).select("s1_id", "cand_id").distinct()


def _key_sets(rows: DataFrame, name: str) -> DataFrame:
    """``name`` (an entity id) and ``keys``, what its rows are matched by; one row for each id."""
    key = ["p_name", "p_brand", "country"]
    return rows.dropna(subset=key).groupBy(F.col("entity_id").alias(name)).agg(F.array_sort(F.collect_set(F.struct(*key))).alias("keys"))


def part_keys(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``s1_id, keys`` and ``cand_id, keys``: a pair is one of :func:`part_truth` if its keys overlap. The
    pairs themselves grow with the square of the rows that share a key."""
    rows = entities(spark, sf_dir)
    return _key_sets(source(rows, 1), "s1_id"), _key_sets(rows.filter(~F.startswith("entity_id", F.lit("S1-"))), "cand_id")


def truth_sizes(first: DataFrame, others: DataFrame) -> DataFrame:
    """``s1_id, n_true`` out of :func:`part_keys`. Candidates are counted by their sets of keys, and the sets
    of both sides are matched."""
    mine = first.select("keys").distinct().select(F.col("keys").alias("mine"), F.explode("keys").alias("key"))
    counted = others.groupBy("keys").agg(F.count("*").alias("n")).select(F.col("keys").alias("theirs"), "n", F.explode("keys").alias("key"))
    n_true = mine.join(counted, "key").select("mine", "theirs", "n").distinct().groupBy("mine").agg(F.sum("n").alias("n_true"))
    return first.join(n_true, F.col("keys") == F.col("mine")).select("s1_id", "n_true")


def truth_as_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``s1_id, matches`` of every source-1 entity."""
    lists = part_truth(spark, sf_dir).groupBy("s1_id").agg(F.array_sort(F.collect_list("cand_id")).alias("matches"))
    ids = source(entities(spark, sf_dir), 1).select(F.col("entity_id").alias("s1_id"))
    return ids.join(lists, "s1_id", "left").select("s1_id", F.coalesce("matches", F.array().cast("array<string>")).alias("matches"))


def with_labels(pairs: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(pairs, part_truth(spark, sf_dir))
