"""The corpus pipeline against its stages, each held against plain Python."""

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from strandweave.llm import langid, primer, secrets

from .data import edge_docs, no_docs
from .test_mixing import brute_targets
from .test_packing import check_sequences
from .test_simhash import brute_components, brute_fingerprint


def write(stage, docs, folder):
    stage.write.parquet(str(folder))
    return docs.sparkSession.read.parquet(str(folder))


def keys(docs):
    return sorted((str(r.doc_id), str(r.text)) for r in docs.collect())


def test_stages_against_brute_force(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    named = write(stages["language_id"](spark, docs, small), docs, tmp_path / "0")
    assert named.columns == docs.columns
    assert all(langid.has_letter(r.text) for r in named.collect())
    assert named.count() == sum(langid.has_letter(r.text) for r in docs.collect())

    rows = {r.doc_id: r for r in named.collect()}
    roots = brute_components({i: brute_fingerprint(r.text) for i, r in rows.items()})
    single = write(stages["near_dedup"](spark, named, small), docs, tmp_path / "1")
    assert keys(single) == sorted((str(i), rows[i].text) for i in set(roots.values()))

    masked = write(stages["secret_scan"](spark, single, small), docs, tmp_path / "2")
    novelty = secrets.Novelty(primer.dictionary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    want = sorted((str(i), secrets.scan_text(rows[i].text, novelty, mask=True)[6]) for i in set(roots.values()))
    assert keys(masked) == want and all(r.n_chars == len(r.text) for r in masked.collect())

    mixed = write(stages["mix_sources"](spark, masked, small), docs, tmp_path / "3")
    size = {r.doc_id: len(r.text.split()) for r in masked.collect()}
    source = {r.doc_id: r.source for r in masked.collect()}
    totals, taken, largest = {}, {}, {}
    for i, n in size.items():
        totals[source[i]] = totals.get(source[i], 0) + n
        largest[source[i]] = max(largest.get(source[i], 0), n)
    for r in mixed.collect():
        taken[r.source] = taken.get(r.source, 0) + size[r.doc_id]
    for s, target in brute_targets(totals).items():
        assert abs(taken.get(s, 0) - target) <= largest[s]

    packed = stages["best_fit_packing"](spark, mixed, small).collect()
    check_sequences(packed)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    n_tokens = sum(len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in mixed.collect())
    assert sum(r.length for r in packed) == n_tokens

    # All stages in one give the same pieces.
    whole = corpus_pipeline.run(spark, small).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in whole) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in packed)


def test_stages_on_odd_and_empty_tables(spark, small):
    for docs in (edge_docs(spark), no_docs(spark)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, small)
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert "sequence_id" in docs.columns


def test_rows_without_ids_are_told_apart(spark, small):
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eta"], 40)) for _ in range(4)]
    rows = [(None, t, "en", "s", len(t)) for t in texts + texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.near_dedup(spark, docs, small).collect()
    assert sorted(r.text for r in left) == sorted(texts)
    # Of rows that agree in id and text always the same one stays.
    rows = [(5, texts[0], lang, source, 1) for lang, source in (("fr", "a"), ("en", "z"), ("en", "b"), ("es", None))]
    for k in range(3):
        docs = spark.createDataFrame(rows[k:] + rows[:k], docs.schema).repartition(k + 1)
        assert [(r.lang, r.source) for r in corpus_pipeline.near_dedup(spark, docs, small).collect()] == [("en", "b")]


def test_predictions_take_effect(spark, small):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select(*corpus_pipeline.COLUMNS)
    wrong = docs.withColumn("lang", F.when(F.col("doc_id") % 300 == 7, F.when(F.col("lang") == "de", "en").otherwise("de")).when(F.col("doc_id") % 300 == 8, None).otherwise(F.col("lang")))
    truth = {r.doc_id: r.lang for r in docs.filter("doc_id % 300 in (7, 8)").collect()}
    got = {r.doc_id: r.lang for r in corpus_pipeline.language_id(spark, wrong, small).collect() if r.doc_id in truth}
    assert len(got) == len(truth) > 50 and sum(got[i] == truth[i] for i in truth) >= 0.9 * len(truth)


def test_copies_are_told_apart(spark, small):
    docs = spark.createDataFrame([(7, "some words here", "en", "s", 15)] * 3 + [(8, "w " * 5000, "en", "s", 10_000)] * 2, "doc_id long, text string, lang string, source string, n_chars long")
    rows = corpus_pipeline.pack_sequences(spark, docs, small).collect()
    assert len(rows) == 7 and len({(r.copy, r.piece) for r in rows}) == 7 and len({r.copy for r in rows}) == 5
