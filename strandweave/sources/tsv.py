"""Readers and writers of the tab-separated entity, truth and result files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .scratch import cut_lineage

COLUMNS = ["entity_id", "business_name", "business_address", "country"]
ENTITY_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])
TRAIN_FILES = {"source1": "train_source1.tsv", "source2": "train_source2.tsv", "source3": "train_source3.tsv", "truth": "train_ground_truth.tsv"}
TEST_FILES = {"source1": "test_source1.tsv", "source2": "test_source2.tsv", "source3": "test_source3.tsv"}
MATCHING_FILE, CANDIDATE_FILE = "matching_results.tsv", "candidate_pairs.tsv"
#: In a folder of result lines, the file that holds the header; its name hides it from readers.
HEADER_FILE = "_header"
POOL_QUOTA = 150_000


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def files(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _fs(spark, folder)
    return sorted(s.getPath().toString() for s in fs.listStatus(p))


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def find_dataset(spark: SparkSession, roots: list[str]) -> tuple[str | None, str | None]:
    """Folders of the training and test files: the first root under which each is found."""
    found: dict[str, str] = {}
    for root in roots:
        if not exists(spark, root):
            continue
        fs, p = _fs(spark, root)
        files = fs.listFiles(p, True)
        while files.hasNext():
            at = files.next().getPath()
            for kind, name in (("train", TRAIN_FILES["source1"]), ("test", TEST_FILES["source1"])):
                if at.getName() == name:
                    found.setdefault(kind, at.getParent().toString())
    return found.get("train"), found.get("test")


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line, value``: the lines of one file, or of all files of a folder, in order. ``line`` grows with
    the place in the file (in a folder: with the file's name, then the place); it has gaps, since no pass
    over the data counts what lies before a split."""
    # Splits of a file come in order, so the id of a row grows along it.
    at = F.monotonically_increasing_id()
    if is_folder(spark, path):
        at = F.struct(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), at.alias("at"))
    return spark.read.text(path).select(at.alias("line"), "value")


def header_and_lines(spark: SparkSession, path: str) -> tuple[str | None, DataFrame] | None:
    """Header and the lines below it; None if there is no such file. The header of a folder lies in a file
    of its own, which readers pass over."""
    if not exists(spark, path):
        return None
    lines = numbered_lines(spark, path)
    if exists(spark, f"{path}/{HEADER_FILE}"):
        return _read_small(spark, f"{path}/{HEADER_FILE}").rstrip("\n"), lines
    first = lines.orderBy("line").limit(1).collect()
    if not first:
        return None, lines
    header = first[0]["value"]
    if is_folder(spark, path):
        # Parts of other writers may each begin with it.
        return header, lines.filter(F.col("value") != header)
    return header, lines.filter(F.col("line") > first[0]["line"])


def _read_small(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def _write_small(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()


def dense_numbers(df: DataFrame, order: str, name: str = "row_id") -> DataFrame:
    """Positions 0, 1, ... in the order of a unique column, without a sort in one task: ranges are
    numbered from 0 each, and the ranges' sizes, one row a range, are summed up before them. The rows are
    written once, with their range: ranges come of samples, and another run might draw others."""
    ranged = cut_lineage(df.repartitionByRange(order).withColumn("_p", F.spark_partition_id()))
    counts = ranged.groupBy("_p").agg(F.count("*").alias("_n"))
    starts = counts.withColumn("_s", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    place = F.row_number().over(Window.partitionBy("_p").orderBy(order)) - 1
    return ranged.withColumn("_i", place).join(starts, "_p").withColumn(name, F.col("_i") + F.col("_s")).drop("_p", "_i", "_s")


def read_entities(spark: SparkSession, path: str, quoting: bool = True, multi_line: bool = False) -> DataFrame:
    """All-string entity rows; a missing field is ''. With ``quoting`` a double quote opens a quoted
    field, else fields are the text between tabs. ``row_id`` grows in file order.

    A large file is read by many tasks. Only fields that hold line breaks need ``multi_line``, which reads
    a file in one task."""
    if quoting:
        rows = spark.read.schema(ENTITY_SCHEMA).option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line).csv(path)
        rows = rows.select(F.monotonically_increasing_id().alias("row_id"), *COLUMNS)
    else:
        rows = read_raw_entities(spark, path)
    return rows.select("row_id", *[F.coalesce(c, F.lit("")).alias(c) for c in COLUMNS])


def read_raw_entities(spark: SparkSession, path: str) -> DataFrame:
    """Rows of four tab-separated fields at least, verbatim; the first four are kept."""
    got = header_and_lines(spark, path)
    parts = got[1].withColumn("f", F.split("value", "\t")).filter(F.size("f") >= 4)
    return parts.select(F.col("line").alias("row_id"), *[F.get("f", F.lit(i)).alias(c) for i, c in enumerate(COLUMNS)])


def head(rows: DataFrame, n: int) -> DataFrame:
    """The first n rows in file order."""
    return rows.orderBy("row_id").limit(n)


def truth_lists(lines: DataFrame, sampled: DataFrame) -> DataFrame:
    """``s1_id, matches`` of the lines of sampled entities; of repeated ids the last line counts."""
    f = F.split(F.regexp_replace("value", r"^\s+|\s+$", ""), "\t")
    second = F.get(f, F.lit(1))
    matches = F.when(second.isNull() | (second == ""), F.array().cast("array<string>")).otherwise(F.split(second, ","))
    rows = lines.select("line", F.get(f, F.lit(0)).alias("s1_id"), matches.alias("matches"))
    rows = rows.join(sampled.select(F.col("entity_id").alias("s1_id")).distinct(), "s1_id", "left_semi")
    return rows.groupBy("s1_id").agg(F.max_by("matches", "line").alias("matches"))


def positives(lists: DataFrame) -> DataFrame:
    """``s1_id, cand_id``: the truth one by one, without empty items."""
    return lists.select("s1_id", F.explode("matches").alias("cand_id")).filter("cand_id <> ''").distinct()


def pool_quota(rows: DataFrame, wanted: DataFrame, quota: int = POOL_QUOTA) -> DataFrame:
    """The first ``quota`` rows by ``row_id`` and all later ones whose id is wanted (column ``cand_id``).

    The quota's last row id comes from a top-k, so that no window numbers all rows."""
    last = rows.select("row_id").orderBy("row_id").limit(quota).agg(F.max("row_id").alias("_last"))
    ids = wanted.select(F.col("cand_id").alias("entity_id")).distinct().withColumn("_w", F.lit(True))
    marked = rows.join(ids, "entity_id", "left")
    return marked.filter((F.col("row_id") <= last.scalar()) | F.col("_w").isNotNull()).select(*rows.columns)


def read_ids(spark: SparkSession, path: str) -> DataFrame | None:
    """``s1``: distinct first fields below the header, stripped; None if there is no such file."""
    try:
        got = header_and_lines(spark, path)
    except AnalysisException:
        return None
    if got is None:
        return None
    filled = got[1].filter(F.regexp_replace("value", r"\s+", "") != "")
    return filled.select(F.regexp_replace(F.get(F.split("value", "\t"), F.lit(0)), r"^\s+|\s+$", "").alias("s1")).distinct()


def write_lists(lists: DataFrame, path: str, column: str) -> None:
    """``source1_entity_id`` and the list column as tab-separated lines in row order: a folder of parts
    without headers, in the order of their names, and the header in a file of its own."""
    ordered = lists.orderBy("q_row").select(F.concat_ws("\t", F.coalesce("source1_entity_id", F.lit("")), F.coalesce(column, F.lit(""))).alias("value"))
    ordered.write.mode("overwrite").text(path)
    write_header(lists.sparkSession, path, ["source1_entity_id", column])


def write_header(spark: SparkSession, path: str, columns: list[str]) -> None:
    """The header of a folder of parts."""
    _write_small(spark, f"{path}/{HEADER_FILE}", "\t".join(columns) + "\n")


def merge_lists(spark: SparkSession, folder: str, file: str) -> None:
    """One file out of a folder of :func:`write_lists`: the header, then the parts in order. The bytes
    stream through the driver; nothing of their number is held."""
    fs, _ = _fs(spark, folder)
    out_fs, target = _fs(spark, file)
    parts = [f for f in files(spark, folder) if "/part-" in f]
    out = out_fs.create(target, True)
    try:
        for path in [f"{folder}/{HEADER_FILE}", *parts]:
            stream = fs.open(_fs(spark, path)[1])
            try:
                stream.transferTo(out)
            finally:
                stream.close()
    finally:
        out.close()
