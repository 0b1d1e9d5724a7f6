"""A training corpus from raw documents, in five stages.

Language identification rejects documents without a language, near-duplicate removal keeps one
document of each group, the secret scan masks what it finds, mixing brings the sources to their
target weights, and packing lays the documents into sequences. Every stage works on all rows of its
predecessor, is written as Parquet and read again.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandweave.llm import langid, mixing, packing, secrets, simhash
from strandweave.llm.common import cut_lineage, shared_folder
from strandweave.sources.tsv import delete

#: Score from which a predicted language replaces a given one.
SURE = 0.9
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _own_columns(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language go on. ``lang`` becomes the predicted language where its score is
    ``SURE`` at least, and where none was given; else it stays.

    Null and letterless texts are rejected, however long; repeated rows are judged alike; ties of scores go
    to the language that sorts first; without a label to learn from no language is set."""
    docs = _own_columns(docs)
    net = langid.fit(docs)
    named = langid.identify(docs, net, COLUMNS, keep_text=True)
    has_letter = (F.col("lang_pred") != langid.UNDETERMINED) | (F.col("score") == 0.0)
    pred = F.when(F.col("lang_pred") != langid.UNDETERMINED, F.col("lang_pred"))
    lang = F.when(F.col("score") >= SURE, F.coalesce(pred, "lang")).otherwise(F.coalesce("lang", pred))
    return named.filter(has_letter).withColumn("lang", lang).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group one row stays: that of the smallest doc_id (null last), then of the
    smallest text hash. Rows without an id are told apart by their texts.

    Null and blank texts are one group. Of rows that agree in id and text the one of the smallest language,
    source and length stays, null first, so that reruns agree."""
    docs = _own_columns(docs)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    key = {"_n": F.isnull("doc_id"), "_i": F.coalesce("doc_id", F.lit(0).cast("long")), "_z": F.isnull("text"), "_t": digest}
    keyed = docs.withColumns(key)
    found = simhash.near_duplicates(keyed.withColumn("_key", F.struct(*key)), id_col="_key")
    firsts = found.filter(F.col("_key") == F.col("component_id")).select("_key.*").distinct()
    # Rows of one key have one text: what tells them apart is narrow. Pre-aggregated in each task.
    rest = F.min(F.struct("lang", "source", "n_chars")).alias("rest")
    single = keyed.join(firsts, list(key), "left_semi").groupBy(*key).agg(rest, F.first("text").alias("text"), F.first("doc_id").alias("doc_id"))
    return single.select("doc_id", "text", "rest.lang", "rest.source", "rest.n_chars")


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are masked in the text; the document stays, with its new length.

    A null text becomes the empty one; very long texts are masked whole; repeated rows stay repeated."""
    found = secrets.scan(_own_columns(docs), [c for c in COLUMNS if c != "text"], mask=True, vocabulary=public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return found.withColumnRenamed("masked_text", "text").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them. Null texts have no words; a null source is the last one;
    repeated rows are taken one by one."""
    return mixing.mix(_own_columns(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece, with its place in a sequence. ``copy`` tells the rows of one document apart that
    mixing has repeated: all pieces of a row share it. Null texts are one piece with the end id alone."""
    rows = _own_columns(docs).withColumn("copy", F.monotonically_increasing_id())
    return packing.pack(rows, public_tokenizers.path("word_bpe_49k.json"), ["doc_id", "copy"])


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scan", mask_secrets),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Tokenization, SimHash and the trained network are beyond SQL; the tests hold run() against a
#: brute-force version of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What lies between two stages goes to the checkpoint folder, and a
    stage's table is deleted when the next one is written."""
    folder = f"{shared_folder(spark)}/stages-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            delete(spark, f"{folder}/{k - 1}")
    # The pieces don't need the texts any more: they are behind a checkpoint of their own.
    packed = cut_lineage(STAGES[-1][1](spark, docs, sf_dir))
    delete(spark, folder)
    return packed
