"""Checks of written id lists, as one report of errors and warnings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MATCHING_HEADER = ["source1_entity_id", "matched_entity_ids"]
CANDIDATE_HEADER = ["source1_entity_id", "candidate_entity_ids"]
EXAMPLES = 5
REPORT = "file string, severity string, finding string, n long, examples string"


def header_problem(header: Column, expected: list[str]) -> Column:
    """Name of the first check that a header line fails; null if none."""
    columns = F.transform(F.split(header, "\t"), lambda c: F.lower(F.regexp_replace(c, r"^\s+|\s+$", "")))
    return (
        F.when(header.isNull() | (header == ""), "empty_file")
        .when(~F.contains(header, F.lit("\t")) & F.contains(header, F.lit(",")), "comma_separated")
        .when(columns != F.array(*map(F.lit, expected)), "unexpected_header")
    )


def id_rows(lines: DataFrame) -> DataFrame:
    """``line, s1, ids, malformed`` of the lines ``(line, value)`` below the header; blank lines go.

    Only the first tab parts a line."""
    at = F.instr("value", "\t")
    blank = F.regexp_replace("value", r"\s+", "") == ""
    rest = F.when(at > 0, F.substr(F.col("value"), at + 1)).otherwise("")
    ids = F.when(F.regexp_replace(rest, r"\s+", "") == "", F.array().cast("array<string>")).otherwise(F.split(rest, ","))
    s1 = F.when(at > 0, F.substr(F.col("value"), F.lit(1), at - 1))
    return lines.filter((at > 0) | ~blank).select("line", s1.alias("s1"), ids.alias("ids"), (at == 0).alias("malformed"))


def _summary(offenders: DataFrame, file: str) -> DataFrame:
    """One row a finding with the number of its offenders and the first few. ``offenders``: (severity,
    finding, o). The few are cut in each task before they are shuffled, and the numbers are pre-aggregated."""
    names = offenders.distinct()
    place = F.row_number().over(Window.partitionBy("severity", "finding").orderBy("o"))
    few = names.withColumn("r", place).filter(F.col("r") <= EXAMPLES).groupBy("severity", "finding").agg(F.array_join(F.array_sort(F.collect_list("o")), ", ").alias("few"))
    t = names.groupBy("severity", "finding").agg(F.count("*").alias("n")).join(few, ["severity", "finding"])
    text = F.when(F.col("n") > EXAMPLES, F.concat(F.col("n").cast("string"), F.lit(" total, e.g. "), F.col("few"), F.lit(", ..."))).otherwise(F.col("few"))
    return t.select(F.lit(file).alias("file"), "severity", "finding", "n", text.alias("examples"))


def row_offenders(rows: DataFrame, required: DataFrame) -> DataFrame:
    """``severity, finding, o`` of one file's rows against the required ids (column ``s1``): one pass for
    what a row shows by itself, and one full join of the ids for what their set shows."""
    good, own = ~F.col("malformed"), lambda c: F.startswith(c, F.lit("S1-"))
    of_prefix = lambda c: F.when(own(c), "self_match").when(~(F.startswith(c, F.lit("S2-")) | F.startswith(c, F.lit("S3-"))), "wrong_prefix")
    entry = lambda finding, o: F.struct(finding.alias("finding"), o.alias("o"))
    none = F.lit(None).cast("string")
    of_row = F.array(
        entry(F.when(~good, "malformed_row").otherwise(none), F.col("line").cast("string")),
        entry(F.when(good & (F.size("ids") != F.size(F.array_distinct("ids"))), "repeated_id").otherwise(none), F.col("s1")),
    )
    of_ids = F.when(good, F.transform("ids", lambda c: entry(of_prefix(c), c)))
    every = F.filter(F.concat(of_row, F.coalesce(of_ids, F.array().cast("array<struct<finding:string,o:string>>"))), lambda e: e["finding"].isNotNull())
    by_row = rows.select(F.inline(every))
    seen = rows.filter(good).groupBy("s1").agg(F.count("*").alias("n"))
    both = seen.join(required.select("s1").distinct().withColumn("needed", F.lit(True)), "s1", "full")
    checks = F.array(F.when(F.col("n") > 1, "duplicate_row"), F.when(F.col("n").isNull(), "missing_entity"), F.when(F.col("needed").isNull(), "unexpected_entity"))
    by_id = both.select(F.explode(F.array_compact(checks)).alias("finding"), F.col("s1").alias("o"))
    return by_row.unionByName(by_id).select(F.lit("error").alias("severity"), "finding", "o")


def row_findings(rows: DataFrame, required: DataFrame, file: str) -> DataFrame:
    """All checks of one file's rows against the required ids (column ``s1``)."""
    return _summary(row_offenders(rows, required), file)


def subset_warning(matched: DataFrame, candidates: DataFrame) -> DataFrame:
    """Entities with a matched id that isn't among their candidates. Of repeated rows the last counts."""
    def last(rows: DataFrame) -> DataFrame:
        good = rows.filter(~F.col("malformed"))
        return good.groupBy("s1").agg(F.max_by("ids", "line").alias("ids"))

    m = last(matched).select("s1", F.explode("ids").alias("id"))
    c = last(candidates).select("s1", F.explode("ids").alias("id"))
    offenders = m.join(c, ["s1", "id"], "left_anti").select(F.lit("warning").alias("severity"), F.lit("not_among_candidates").alias("finding"), F.col("s1").alias("o"))
    return _summary(offenders, "matching")


def counters(rows: DataFrame) -> DataFrame:
    """One row: n_rows, n_empty, n_filled."""
    empty = F.size("ids") == 0
    return rows.filter(~F.col("malformed")).agg(F.count("*").alias("n_rows"), F.count_if(empty).alias("n_empty"), F.count_if(~empty).alias("n_filled"))


def report(matched: DataFrame, candidates: DataFrame, required: DataFrame) -> DataFrame:
    """Errors of both files and the warning across them; ``id_rows`` of each, and the required ids."""
    return (
        row_findings(matched, required, "matching")
        .unionByName(row_findings(candidates, required, "candidates"))
        .unionByName(subset_warning(matched, candidates))
    )


def validate_files(spark, matching_path: str, candidate_path: str, source1_path: str) -> DataFrame:
    """Report on written files: existence, header, then rows. A file that fails early has no row checks."""
    from ..sources.tsv import header_and_lines, read_ids

    def problem(file: str, check: str) -> DataFrame:
        return spark.createDataFrame([(file, "error", check, 1, file)], REPORT)

    required = read_ids(spark, source1_path)
    if required is None:
        return problem(source1_path, "file_not_found")
    found, rows = [], {}
    for file, path, expected in (("matching", matching_path, MATCHING_HEADER), ("candidates", candidate_path, CANDIDATE_HEADER)):
        got = header_and_lines(spark, path)
        check = "file_not_found" if got is None else spark.range(1).select(header_problem(F.lit(got[0]).cast("string"), expected)).first()[0]
        if check:
            found.append(problem(file, check))
        else:
            rows[file] = id_rows(got[1])
            found.append(row_findings(rows[file], required, file))
    if len(rows) == 2:
        found.append(subset_warning(rows["matching"], rows["candidates"]))
    out = found[0]
    for one in found[1:]:
        out = out.unionByName(one)
    return out


def list_column(ids: Column) -> Column:
    """A comma-joined list as an array; blank: empty."""
    return F.when(F.trim(ids) == "", F.array().cast("array<string>")).otherwise(F.split(ids, ","))
