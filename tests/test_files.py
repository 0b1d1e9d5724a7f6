"""Files to files: readers, writers, training, inference, validation."""

import pytest
from pyspark.sql import functions as F

from strandweave.operators import learn, validate
from strandweave.plans import adapters, pipeline
from strandweave.sources import tsv


def write(path, lines):
    path.write_text("".join(f"{x}\n" for x in lines), encoding="utf-8")
    return str(path)


def test_readers(spark, tmp_path):
    p = write(tmp_path / "e.tsv", ["entity_id\tbusiness_name\tbusiness_address\tcountry", 'S1-1\t"a ""q"" b"\t\tUS', "S1-2\tNA\tnull\t007", "S1-3\tx"])
    quoted = [tuple(r)[1:] for r in tsv.read_entities(spark, p).orderBy("row_id").collect()]
    assert quoted[:2] == [("S1-1", 'a "q" b', "", "US"), ("S1-2", "NA", "null", "007")]
    raw = [tuple(r)[1:] for r in tsv.read_entities(spark, p, quoting=False).orderBy("row_id").collect()]
    assert raw == [("S1-1", '"a ""q"" b"', "", "US"), ("S1-2", "NA", "null", "007")]
    assert [r.entity_id for r in tsv.head(tsv.read_entities(spark, p), 1).collect()] == ["S1-1"]
    assert {r.s1 for r in tsv.read_ids(spark, p).collect()} == {"S1-1", "S1-2", "S1-3"}
    assert tsv.read_ids(spark, str(tmp_path / "none.tsv")) is None
    write(tmp_path / "train_source1.tsv", ["x"])
    assert tsv.find_dataset(spark, ["/nowhere", str(tmp_path)]) == (f"file:{tmp_path}", None)


def test_truth_and_quota(spark, tmp_path):
    p = write(tmp_path / "t.tsv", ["a\tb", "S1-1\tS2-1,,S3-1", "S1-2", "S1-1\tS2-9", "S1-7\tS2-7"])
    ids = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    lists = tsv.truth_lists(tsv.header_and_lines(spark, p)[1], ids)
    assert {r.s1_id: r.matches for r in lists.collect()} == {"S1-1": ["S2-9"], "S1-2": []}
    rows = spark.range(20).selectExpr("id * 3 as row_id", "concat('S2-', id) as entity_id")
    wanted = spark.createDataFrame([("S2-15",), ("S2-2",)], "cand_id string")
    assert sorted(r.row_id // 3 for r in tsv.pool_quota(rows, wanted, 4).collect()) == [0, 1, 2, 3, 15]


def test_exact_group_split(spark):
    rows = spark.range(1000).select(F.concat(F.lit("S1-"), (F.col("id") % 101).cast("string")).alias("s1_id"), "id")
    got = learn.group_split(rows).groupBy("s1_id").agg(F.min("is_val").alias("a"), F.max("is_val").alias("b")).collect()
    assert len(got) == 101 and all(r.a == r.b for r in got) and sum(r.a for r in got) == 26  # a quarter, rounded up


def test_dense_numbers(spark):
    rows = spark.range(500).selectExpr("(id * 7919) % 100003 as k")
    got = sorted((r.k, r.row_id) for r in tsv.dense_numbers(rows, "k").collect())
    assert [i for _, i in got] == list(range(500))


def entity_files(spark, sf_dir, folder, prefix):
    rows = adapters.entities(spark, sf_dir).orderBy("row_id").collect()
    for n in (1, 2, 3):
        own = [r for r in rows if r.entity_id.startswith(f"S{n}-")]
        write(folder / f"{prefix}_source{n}.tsv", ["\t".join(tsv.COLUMNS), *("\t".join(r[c] for c in tsv.COLUMNS) for r in own)])
    return [r for r in rows if r.entity_id.startswith("S1-")]


def test_large_files_are_read_by_many_tasks(spark, tmp_path):
    lines = [f'S2-{i}\t"name {i}"\tstreet {i % 97}\tUS' for i in range(20_000)]
    p = write(tmp_path / "large.tsv", ["\t".join(tsv.COLUMNS), *lines])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "4k")
    try:
        for quoting in (True, False):
            rows = tsv.read_entities(spark, p, quoting=quoting)
            assert rows.rdd.getNumPartitions() > 4
            assert [r.entity_id for r in rows.orderBy("row_id").collect()] == [f"S2-{i}" for i in range(20_000)]
        whole = tsv.read_entities(spark, p, multi_line=True)
        assert whole.rdd.getNumPartitions() == 1 and whole.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_results_in_parts_pass_their_own_validation(spark, tmp_path):
    n = 4000
    rows = spark.range(n).select(F.col("id").alias("q_row"), F.concat(F.lit("S1-"), F.col("id").cast("string")).alias("source1_entity_id"), F.when(F.col("id") % 3 == 0, "").otherwise(F.concat(F.lit("S2-"), F.col("id").cast("string"), F.lit(",S3-1"))).alias("ids"))
    required = write(tmp_path / "s1.tsv", ["entity_id", *(f"S1-{i}" for i in range(n))])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        paths = []
        for column in ("matched_entity_ids", "candidate_entity_ids"):
            paths.append(str(tmp_path / column))
            tsv.write_lists(rows.withColumnRenamed("ids", column).repartition(7), paths[-1], column)
            assert len(list((tmp_path / column).glob("part-*"))) == 4
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert validate.validate_files(spark, *paths, required).collect() == []
    header, lines = tsv.header_and_lines(spark, paths[0])
    assert header == "source1_entity_id\tmatched_entity_ids"
    want = [f"S1-{i}\t" + ("" if i % 3 == 0 else f"S2-{i},S3-1") for i in range(n)]
    assert [r.value for r in lines.orderBy("line").collect()] == want
    single = str(tmp_path / "single.tsv")
    tsv.merge_lists(spark, paths[0], single)
    assert (tmp_path / "single.tsv").read_text() == "".join(f"{x}\n" for x in [header, *want])
    assert validate.validate_files(spark, single, paths[1], required).collect() == []
    # Parts of other writers, each with its header.
    (tmp_path / "other").mkdir()
    for k in range(3):
        write(tmp_path / "other" / f"part-{k}.tsv", [header, *want[k::3]])
    assert validate.validate_files(spark, str(tmp_path / "other"), paths[1], required).collect() == []


def test_train_infer_validate(spark, small, tmp_path):
    first = entity_files(spark, small, tmp_path, "train")
    entity_files(spark, small, tmp_path, "test")
    lists = {r.s1_id: r.matches for r in adapters.truth_as_lists(spark, small).collect()}
    write(tmp_path / "train_ground_truth.tsv", ["id\tmatches", *(f"{s}\t{','.join(m)}" for s, m in lists.items())])
    models, out = str(tmp_path / "models"), str(tmp_path / "out")
    ensemble = pipeline.train(spark, str(tmp_path), models, trees=3, population="all")
    assert 0 <= ensemble.tuning.val_macro_f05 <= 1 and 0 < ensemble.tuning.blocking_recall_ceiling <= 1
    totals = pipeline.infer(spark, str(tmp_path), out, models)
    assert totals["processed"] == len(first) == totals["matched"] + totals["singletons"] and totals["seconds"] > 0
    files = [f"{out}/{tsv.MATCHING_FILE}", f"{out}/{tsv.CANDIDATE_FILE}", str(tmp_path / "test_source1.tsv")]
    assert validate.validate_files(spark, *files).collect() == []
    pipeline.infer(spark, str(tmp_path), str(tmp_path / "single"), models, single_files=True)
    assert sorted(x.name for x in (tmp_path / "single").iterdir() if not x.name.startswith(".")) == [tsv.CANDIDATE_FILE, tsv.MATCHING_FILE]
    lines = (tmp_path / "single" / tsv.MATCHING_FILE).read_text().split("\n")
    assert lines[0] == "source1_entity_id\tmatched_entity_ids" and [x.split("\t")[0] for x in lines[1:-1]] == [r.entity_id for r in first]
    again = learn.Ensemble.load(models)
    assert again.tuning == ensemble.tuning
    assert pipeline.infer(spark, str(tmp_path), out, models, max_records=5)["processed"] == 5
    report = {(r.file, r.finding) for r in validate.validate_files(spark, *files).collect()}
    assert report == {("matching", "missing_entity"), ("candidates", "missing_entity")}
    assert len(again.importances(spark).collect()) == 15
    with pytest.raises(ValueError, match="population"):
        pipeline.train(spark, str(tmp_path), models, population="some")


def test_validation_of_faulty_files(spark, tmp_path):
    required = write(tmp_path / "s1.tsv", ["entity_id", "S1-1", "S1-2", "S1-3"])
    good = write(tmp_path / "c.tsv", ["Source1_Entity_ID \tcandidate_entity_ids", "S1-1\tS2-1", "S1-2\t", "S1-3\tS3-1"])
    bad = write(tmp_path / "m.tsv", ["source1_entity_id\tmatched_entity_ids", "S1-1\tS2-1,S2-1", "S1-1\tS2-4", "broken", "", "S1-9\tS1-1,X-1,", "S1-2\tS2-8"])
    got = {(r.severity, r.finding): (r.n, r.examples) for r in validate.validate_files(spark, bad, good, required).collect()}
    assert got.pop(("error", "malformed_row"))[0] == 1
    assert got == {
        ("error", "duplicate_row"): (1, "S1-1"), ("error", "repeated_id"): (1, "S1-1"), ("error", "self_match"): (1, "S1-1"), ("error", "wrong_prefix"): (2, ", X-1"),
        ("error", "missing_entity"): (1, "S1-3"), ("error", "unexpected_entity"): (1, "S1-9"), ("warning", "not_among_candidates"): (3, "S1-1, S1-2, S1-9"),
    }
    finding = lambda *paths: {r.finding for r in validate.validate_files(spark, *paths).collect()}
    commas = write(tmp_path / "x.tsv", ["source1_entity_id,matched_entity_ids"])
    header = write(tmp_path / "y.tsv", ["a\tb"])
    empty = write(tmp_path / "z.tsv", [])
    assert "comma_separated" in finding(commas, good, required) and "unexpected_header" in finding(header, good, required)
    assert "empty_file" in finding(empty, good, required) and "file_not_found" in finding(str(tmp_path / "no"), good, required)
    assert finding(good, good, str(tmp_path / "no")) == {"file_not_found"}
    rows = validate.id_rows(tsv.header_and_lines(spark, bad)[1])
    assert tuple(validate.counters(rows).first()) == (4, 0, 4)
