"""Two tree learners on pair features, their blend, and the scores of new pairs.

The learners are Spark's own (gradient-boosted trees and a random forest). Scores differ from those of
other boosting libraries; what is offered is the same: two decorrelated class probabilities, a tuned
blend and threshold, importances, and models that can be saved.
"""

from __future__ import annotations

import json
import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from itertools import accumulate

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.scratch import cut_lineage
from . import metrics
from .features import FEATURE_NAMES

VALIDATION_SHARE, SEED = 0.25, 42
#: Hexadecimal digits by which the hashes of a split are counted.
PREFIX_DIGITS = 4
#: Counts the training rows that are equal.
TIMES = "n_rows"
#: Training rows that a task of the learners takes, and at most if there are more tasks than cores.
ROWS_PER_TASK, MOST_ROWS = 32_768, 131_072
GBT_FOLDER, FOREST_FOLDER, METADATA_FOLDER = "gbt_model", "forest_model", "metadata"


def group_split(rows: DataFrame, key: str = "s1_id", share: float = VALIDATION_SHARE, seed: int = SEED) -> DataFrame:
    """``rows`` with ``is_val``: ``share`` of the keys, rounded up, each wholly on one side.

    Those with the smallest hashes are held out: the same ones on every run. Keys are counted by the first
    digits of their hashes, and only those of one such group are sorted to find the last one held out;
    ``rows`` are compared with it and not joined."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    # Written once: counted, then looked up.
    keys = cut_lineage(rows.select(F.col(key).alias("_k")).filter(F.col("_k").isNotNull()).distinct())
    hashed = keys.select("_k", F.md5(F.concat(F.lit(f"{seed}:"), F.col("_k").cast("string")).cast("binary")).alias("_h"))
    counts = sorted(hashed.groupBy(F.substring("_h", 1, PREFIX_DIGITS).alias("p")).agg(F.count("*").alias("n")).collect())
    n = math.ceil(sum(c for _, c in counts) * share)
    if not n:
        return rows.withColumn("is_val", F.lit(False))
    prefix, before = next((p, end - c) for (p, c), end in zip(counts, accumulate(c for _, c in counts), strict=True) if end >= n)
    last = hashed.filter(F.startswith("_h", F.lit(prefix))).orderBy("_h", "_k").limit(n - before).agg(F.max(F.struct("_h", "_k")).alias("m")).first()["m"]
    held = (h < last["_h"]) | ((h == last["_h"]) & (F.col(key) <= F.lit(last["_k"])))
    return rows.withColumn("is_val", F.coalesce(held, F.lit(False)))


@dataclass
class Tuning:
    model_name: str
    gbt_weight: float
    forest_weight: float
    optimal_threshold: float
    val_macro_f05: float
    blocking_recall_ceiling: float
    features: list[str]
    gpu_active: bool = False


class Ensemble:
    """A boosted and a bagged model with their blend."""

    def __init__(self, gbt: PipelineModel, forest: PipelineModel, tuning: Tuning | None = None):
        self.gbt, self.forest, self.tuning = gbt, forest, tuning

    def probabilities(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``prob_a`` and ``prob_b``."""
        out = rows
        for model, name in ((self.gbt, "prob_a"), (self.forest, "prob_b")):
            raw = [c for s in model.stages for c in ("features", "rawPrediction", "prediction") if c]
            out = model.transform(out).withColumn(name, vector_to_array("probability")[1]).drop("probability", *set(raw))
        return out

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``prob_a``, ``prob_b``, ``prob`` and ``accepted``."""
        return self.blended(self.probabilities(rows))

    def blended(self, rows: DataFrame) -> DataFrame:
        """``rows`` that have both probabilities, with ``prob`` and ``accepted``."""
        w = self.tuning.gbt_weight if self.tuning else 0.5
        t = self.tuning.optimal_threshold if self.tuning else 0.65
        blended = rows.withColumn("prob", w * F.col("prob_a") + (1.0 - w) * F.col("prob_b"))
        return blended.withColumn("accepted", F.col("prob") >= t)

    def importances(self, spark: SparkSession, top: int = 15) -> DataFrame:
        """``feature, importance``: the mean of both models' shares, the largest first."""
        shares = []
        for model in (self.gbt, self.forest):
            v = model.stages[-1].featureImportances.toArray()
            shares.append(v / (v.sum() + 1e-9))
        mean = (shares[0] + shares[1]) / 2
        rows = [(f, float(x)) for f, x in zip(FEATURE_NAMES, mean, strict=True)]
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(top)

    def save(self, folder: str) -> None:
        self.gbt.write().overwrite().save(f"{folder}/{GBT_FOLDER}")
        self.forest.write().overwrite().save(f"{folder}/{FOREST_FOLDER}")
        if self.tuning:
            spark = SparkSession.getActiveSession()
            spark.createDataFrame([(json.dumps(asdict(self.tuning)),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/{METADATA_FOLDER}")

    @staticmethod
    def load(folder: str) -> Ensemble:
        spark = SparkSession.getActiveSession()
        kept = json.loads(spark.read.text(f"{folder}/{METADATA_FOLDER}").first()["value"])
        # Missing weights count as an even blend; the threshold has to be there.
        known = {"model_name": "", "gbt_weight": 0.5, "forest_weight": 0.5, "val_macro_f05": math.nan, "blocking_recall_ceiling": math.nan, "features": FEATURE_NAMES}
        tuning = Tuning(**(known | {k: v for k, v in kept.items() if k in Tuning.__dataclass_fields__}))
        return Ensemble(PipelineModel.load(f"{folder}/{GBT_FOLDER}"), PipelineModel.load(f"{folder}/{FOREST_FOLDER}"), tuning)


def fit_models(train: DataFrame, trees: int = 250, step: float = 0.06, depth: int = 6, share: float = 0.85, seed: int = SEED) -> Ensemble:
    """Fit both learners on feature rows with ``is_match``; positives weigh negatives / positives.

    Rows that are equal become one that weighs as much as all of them. ``train`` may have done so in part and
    count them in ``TIMES``. The learners draw their samples (``share``) of these rows.

    A boosted tree takes two stages a level, one level after the other. Rows are dealt to as many tasks as
    their number asks for, so that those stages compute and don't just start tasks, and to no second wave of
    tasks before they are many. Both learners run at the same time."""
    times = F.col(TIMES) if TIMES in train.columns else F.lit(1).cast("long")
    rows = cut_lineage(train.groupBy(*FEATURE_NAMES, "is_match").agg(F.sum(times).alias(TIMES)))
    balance = metrics.class_balance(rows, TIMES).first()
    n = rows.count()
    tasks = min(math.ceil(n / ROWS_PER_TASK) or 1, max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(n / MOST_ROWS)))
    weight = F.col(TIMES) * F.when(F.col("is_match") == 1, float(balance["scale_pos_weight"])).otherwise(1.0)
    # The same rows in the same order on every run.
    dealt = rows.repartition(tasks, *FEATURE_NAMES).sortWithinPartitions(*FEATURE_NAMES, "is_match")
    weighted = dealt.withColumn("_w", weight).withColumn("label", F.col("is_match").cast("double"))
    vectors = VectorAssembler(inputCols=FEATURE_NAMES, outputCol="features")
    common = {"labelCol": "label", "featuresCol": "features", "weightCol": "_w", "maxDepth": depth, "subsamplingRate": share, "seed": seed}
    ready = vectors.transform(weighted).select("features", "label", "_w").persist()
    try:
        learners = (
            GBTClassifier(maxIter=trees, stepSize=step, featureSubsetStrategy=str(share), **common),
            RandomForestClassifier(numTrees=trees, featureSubsetStrategy="sqrt", **common),
        )
        ready.count()
        with ThreadPoolExecutor(len(learners)) as pool:
            gbt, forest = pool.map(inheritable_thread_target(train.sparkSession)(lambda learner: learner.fit(ready)), learners)
    finally:
        ready.unpersist()
    return Ensemble(PipelineModel([vectors, gbt]), PipelineModel([vectors, forest]))


def tune(ensemble: Ensemble, validation: DataFrame, truth: DataFrame, recall: float = math.nan, ids: DataFrame | None = None) -> Tuning:
    """Choose blend weight and threshold by macro F0.5 on validation pairs, which may have their probabilities
    already. ``truth`` as in :func:`metrics.grid`."""
    scored = validation if "prob_b" in validation.columns else ensemble.probabilities(validation)
    scored = scored.select("s1_id", "cand_id", "prob_a", "prob_b", "is_match")
    best = metrics.best_cell(metrics.grid(scored, truth, ids)).first()
    w, t, f = (best["weight"], best["threshold"], best["macro_f05"]) if best else (0.5, 0.65, math.nan)
    ensemble.tuning = Tuning("gbt_forest_blend", w, 1.0 - w, t, f, recall, list(FEATURE_NAMES))
    return ensemble.tuning
