"""Every linkage query on the smallest tables, against its DuckDB SQL where there is one."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from strandweave.operators import blocking, features, learn
from strandweave.operators.features import FEATURE_NAMES
from strandweave.plans import adapters, queries
from strandweave.plans.queries import ORACLE_SQL, QUERIES

from strandweave.sources import tsv

from .oracle import assert_same


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(ORACLE_SQL)))
def test_against_sql(spark, small, name):
    assert_same(QUERIES[name](spark, small), ORACLE_SQL[name], small)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_rows(spark, small, name):
    rows = QUERIES[name](spark, small).collect()
    assert rows
    if name == "q_feat_token_ratios":
        assert all(0 <= r[c] <= 1 for r in rows for c in r.asDict() if c not in ("q_row", "cand_idx"))


def test_every_rule_has_rows(spark, small):
    assert QUERIES["q_rule_plot_num"](spark, small).count() > 0
    assert {r.rule for r in QUERIES["q_posting_stats"](spark, small).collect()} == {1, 2, 3, 4, 5, 6}
    assert any("plot_num" in r.reasons for r in QUERIES["q_reasons"](spark, small).collect())


def test_entry(spark):
    frame = __spark_entry__.entry(spark)
    assert frame.count() > 0 and set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["q_model_scores", "q_importances"])
def test_models_are_fitted_with_the_operators_defaults(spark, small, monkeypatch, name):
    fit, given = learn.fit_models, []

    def few(train, **options):
        given.append(options)
        return fit(train, **options | {"trees": 2})

    monkeypatch.setattr(learn, "fit_models", few)
    assert QUERIES[name](spark, small).count() > 0 and given == [{}]


@pytest.mark.parametrize("name, column", [("q_unicode_clean", "name_clean"), ("q_name_tokens", "n_text")])
def test_whole_texts_are_read(spark, small, name, column):
    words = {r.doc_id: len((r.text or "").split()) for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = {r.row_id: len(r[column].split()) for r in QUERIES[name](spark, small).collect()}
    assert got.keys() == words.keys() and max(words.values()) > 1000
    # Legal forms, signs and addresses of sites go; of the words nearly all stay.
    assert sum(got.values()) > 0.9 * sum(words.values())


def test_learners_get_as_many_tasks_as_the_rows_ask_for(spark, monkeypatch):
    rows = spark.range(400).repartition(40)
    rows = rows.select((rows.id % 4 == 0).cast("int").alias("is_match"), *[((rows.id * (i + 3)) % 17).cast("float").alias(f) for i, f in enumerate(FEATURE_NAMES)])
    seen = []
    for learner in (learn.GBTClassifier, learn.RandomForestClassifier):
        monkeypatch.setattr(learner, "fit", lambda self, df, fit=learner.fit: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    ensemble = learn.fit_models(rows, trees=2)
    assert seen == [1, 1] and ensemble.gbt.stages[-1].getNumTrees == ensemble.forest.stages[-1].getNumTrees == 2


@pytest.mark.parametrize("name", ["q_result_counters", "q_result_lines", "q_importances"])
def test_pairs_are_found_once(spark, small, monkeypatch, name):
    find, fit, found = blocking._best_matches if hasattr(blocking, "_best_matches") else blocking.key_matches, learn.fit_models, []
    monkeypatch.setattr(blocking, find.__name__, lambda *a: found.append(1) or find(*a))
    monkeypatch.setattr(learn, "fit_models", lambda train: fit(train, trees=2))
    assert QUERIES[name](spark, small).count() > 0 and found == [1]


def test_places_of_result_lines_come_from_ranges(spark, small, monkeypatch):
    number, calls = tsv.dense_numbers, []
    monkeypatch.setattr(tsv, "dense_numbers", lambda *a: calls.append(a[1:]) or number(*a))
    places = [r.place for r in QUERIES["q_result_lines"](spark, small).filter("file = 'matching'").collect()]
    assert calls == [("line", "place")] * 2 and sorted(places) == list(range(1, len(places) + 1))


def test_kinds_agree_with_single_pairs(spark, small, tmp_path):
    part = spark.read.parquet(f"{small}/part.parquet")
    # Keys shifted by all moduli of the entities: equal texts in either source.
    part.unionByName(part.withColumn("p_partkey", F.col("p_partkey") + 840)).write.parquet(f"{tmp_path}/part.parquet")
    asked, pairs, kinds, sizes = queries._labelled_kinds(spark, str(tmp_path))
    left, right = adapters.linked_sides(spark, str(tmp_path))
    single = learn.group_split(adapters.with_labels(blocking.candidate_pairs(left, right), spark, str(tmp_path)))
    single = features.pair_features(single, left, right)
    joined = asked.join(pairs, "q_kind").withColumn("is_match", queries._matched()).join(kinds, queries.KIND)
    columns = ["q_row", "s1_id", "cand_idx", "cand_id", "is_val", "is_match", *FEATURE_NAMES]
    got, want = ({tuple(r) for r in df.select(columns).collect()} for df in (joined, single))
    assert got == want and len(got) == pairs.join(asked, "q_kind").count() > 1.5 * kinds.count()
    trained = [sum(not r[4] and r[5] == label for r in want) for label in (0, 1)]
    assert tuple(kinds.agg(F.sum("n0"), F.sum("n1")).first()) == tuple(trained) and min(trained) > 0
    truth = adapters.part_truth(spark, str(tmp_path)).groupBy("s1_id").count()
    assert {tuple(r) for r in sizes.collect()} == {tuple(r) for r in truth.collect()}


def test_equal_training_rows_are_one(spark, monkeypatch):
    rows = spark.range(400).select((F.col("id") % 4 == 0).cast("int").alias("is_match"), *[((F.col("id") % 40) % (i + 2)).cast("float").alias(f) for i, f in enumerate(FEATURE_NAMES)])
    seen, fit = [], learn.GBTClassifier.fit
    monkeypatch.setattr(learn.GBTClassifier, "fit", lambda self, df: seen.append(tuple(df.agg(F.count("*"), F.sum("_w")).first())) or fit(self, df))
    models = [learn.fit_models(df, trees=2) for df in (rows, rows.groupBy(*rows.columns).agg(F.count("*").alias(learn.TIMES)))]
    # 40 kinds of rows; 300 negatives weigh 1 and 100 positives 3.
    assert seen == [(40, 600.0)] * 2
    assert models[0].gbt.stages[-1].toDebugString.split("\n", 1)[1] == models[1].gbt.stages[-1].toDebugString.split("\n", 1)[1]


def test_kinds_are_measured_by_as_many_tasks_as_they_ask_for(spark, monkeypatch):
    schema = "{} long, n_text string, n_tokens array<string>, n_compact string, a_text string, a_postal string, a_num_word string, a_plot string, a_tokens array<string>, country string"
    sides = [spark.createDataFrame([(i, f"x {i % 4}", ["x"], f"x{i % 4}", "y", "", "", "", ["y"], "US") for i in range(20)], schema.format(key)) for key in ("row_id", "cand_idx")]
    kinds = spark.range(20).select(F.col("id").alias("q_kind"), F.col("id").alias("cand_kind"), F.lit("plot_num").alias("reasons"))
    given, measure = [], features.pair_features
    monkeypatch.setattr(features, "ROWS_PER_TASK", 8)
    monkeypatch.setattr(features, "pair_features", lambda *a, **b: given.append(measure(*a, **b)) or given[-1])
    rows = features.distinct_features(kinds, *sides).collect()
    assert len(rows) == 20 and all(r.name_exact == r.addr_exact == r.reason_plot_num == 1 for r in rows)
    # The names of 20 kinds are 4.
    assert [(df.rdd.getNumPartitions(), df.count()) for df in given] == [(3, 4), (3, 20)]
