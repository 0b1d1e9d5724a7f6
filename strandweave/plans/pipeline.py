"""Training and inference from files to files."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalise
from ..operators import learn, metrics
from ..operators.blocking import BlockingConfig, candidate_pairs, candidate_pool, id_lists
from ..operators.features import pair_features
from ..sources import tsv


def train(spark: SparkSession, train_dir: str, models_dir: str, n_sample: int = 50_000, config: BlockingConfig = BlockingConfig(), trees: int = 250, seed: int = learn.SEED, population: str = "with_candidates", quota: int = tsv.POOL_QUOTA) -> learn.Ensemble:
    """Fit, tune and save an ensemble.

    ``population``: entities in the macro average: those with a candidate, or all of the held-out ones.
    """
    if population not in ("with_candidates", "all"):
        raise ValueError(f"unknown population {population!r}")
    path = lambda kind: f"{train_dir}/{tsv.TRAIN_FILES[kind]}"
    first = tsv.head(tsv.read_entities(spark, path("source1")), n_sample).persist()
    lists = tsv.truth_lists(tsv.header_and_lines(spark, path("truth"))[1], first)
    truth = tsv.positives(lists).persist()
    second, third = (tsv.pool_quota(tsv.read_raw_entities(spark, path(k)), truth, quota) for k in ("source2", "source3"))
    queries = normalise(first, ["row_id", "entity_id"]).persist()
    pool = normalise(candidate_pool(second, third), ["cand_idx", "entity_id"]).persist()
    pairs = candidate_pairs(queries, pool, config).persist()
    recall = metrics.recall_ceiling(pairs, lists).first()["recall"]
    rows = learn.group_split(metrics.labelled(pair_features(pairs, queries, pool), truth), seed=seed).persist()
    ensemble = learn.fit_models(rows.filter("not is_val"), trees=trees, seed=seed)
    ids = None
    if population == "all":
        ids = learn.group_split(first.select(F.col("entity_id").alias("s1_id")), seed=seed).filter("is_val")
    learn.tune(ensemble, rows.filter("is_val"), truth, recall, ids)
    ensemble.save(models_dir)
    for df in (first, truth, queries, pool, pairs, rows):
        df.unpersist()
    return ensemble


def link(queries: DataFrame, pool: DataFrame, ensemble: learn.Ensemble, config: BlockingConfig = BlockingConfig()) -> tuple[DataFrame, DataFrame]:
    """Match lists and candidate lists, one row per query row each. Rows that share an id share their
    matches, while candidates stay with their row."""
    pairs = candidate_pairs(queries, pool, config)
    accepted = ensemble.score(pair_features(pairs, queries, pool)).filter("accepted").select("q_row", "s1_id", "cand_id", "rank")
    shared = queries.select(F.col("row_id").alias("_row"), F.col("entity_id").alias("s1_id"))
    mine = accepted.join(shared, "s1_id")
    # Matches come in the order of the rows that brought them, then by rank.
    ranked = mine.groupBy("_row", "cand_id").agg(F.min(F.struct("q_row", "rank")).alias("rank")).withColumnRenamed("_row", "q_row")
    matches = id_lists(queries, ranked, "matched_entity_ids", dedupe=True)
    return matches, id_lists(queries, pairs, "candidate_entity_ids")


def infer(spark: SparkSession, test_dir: str, output_dir: str, models_dir: str, max_records: int | None = None, config: BlockingConfig = BlockingConfig(), single_files: bool = False) -> dict:
    """Write both results, as folders of parts or as single files; returns counts of entities, matched ones
    and singletons, and the seconds that it took."""
    began = time.monotonic()
    ensemble = learn.Ensemble.load(models_dir)
    path = lambda kind: f"{test_dir}/{tsv.TEST_FILES[kind]}"
    first = tsv.read_entities(spark, path("source1"))
    first = tsv.head(first, max_records) if max_records is not None else first
    # Blocking reads either side several times, and the lists share the pairs.
    queries = normalise(first, ["row_id", "entity_id"]).persist()
    pool = normalise(candidate_pool(*(tsv.read_entities(spark, path(k)) for k in ("source2", "source3"))), ["cand_idx", "entity_id"]).persist()
    matches, candidates = link(queries, pool, ensemble, config)
    matches = matches.persist()
    for lists, name, column in ((matches, tsv.MATCHING_FILE, "matched_entity_ids"), (candidates, tsv.CANDIDATE_FILE, "candidate_entity_ids")):
        target = f"{output_dir}/{name}"
        parts = f"{output_dir}/parts-{name}" if single_files else target
        tsv.write_lists(lists, parts, column)
        if single_files:
            tsv.merge_lists(spark, parts, target)
            tsv.delete(spark, parts)
    row = totals(matches).first().asDict()
    for df in (matches, queries, pool):
        df.unpersist()
    seconds = time.monotonic() - began
    return row | {"seconds": round(seconds, 3), "entities_per_second": round(row["processed"] / max(seconds, 1e-9), 1)}


def totals(matches: DataFrame) -> DataFrame:
    """One row: processed, matched, singletons."""
    filled = F.col("matched_entity_ids") != ""
    return matches.agg(F.count("*").alias("processed"), F.count_if(filled).alias("matched"), F.count_if(~filled).alias("singletons"))
