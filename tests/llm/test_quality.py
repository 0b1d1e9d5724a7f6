import numpy as np

from strandweave.llm import quality, queries

from .data import edge_docs, no_docs


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op1_quality_knn(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    held = got.filter("held_out").join(labels, "doc_id").collect()
    assert got.count() == 1000 and len(held) > 100
    assert sum(r.quality == r.predicted for r in held) / len(held) >= 0.95
    bad = [r for r in held if r.quality == 0]
    assert sum(r.predicted == 0 for r in bad) / len(bad) >= 0.9


def test_scores_against_plain_votes():
    rng = np.random.default_rng(2)
    counts = rng.poisson(0.2, (60, quality.N_TERMS))
    labels = rng.integers(0, 2, 60)
    voter = quality.fit_counts(counts, labels)
    probe = rng.poisson(0.2, (7, quality.N_TERMS))
    x = voter.project(probe).astype(np.float64)
    for row, got in zip(x, voter.score(probe), strict=True):
        cosines = [float(row @ v) for v in voter.vectors.astype(np.float64)]
        near = sorted(range(60), key=lambda i: -cosines[i])[: quality.NEIGHBOURS]
        weight = [max(cosines[i], 1e-6) ** quality.SHARPNESS for i in near]
        assert abs(got - sum(w * labels[i] for w, i in zip(weight, near, strict=True)) / sum(weight)) < 1e-3


def test_terms_count_every_byte_once(monkeypatch):
    text = "Äpfel, birnen & KIRSCHEN!!\n" * 50
    whole = quality.terms(text)
    n = len(text.encode())
    assert whole[: quality.N_PAIRS].sum() == n - 1 and whole[quality.N_PAIRS :].sum() == n - 3
    monkeypatch.setattr(quality, "STRETCH", 101)
    assert (quality.terms(text) == whole).all()


def test_odd_rows(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(6, 0), (6, 1), (8, 1), (11, 1), (None, 1), (12, None), (99, 0)], "doc_id long, quality int")
    voter = quality.fit(docs, labels)
    got = quality.classify(docs, voter, ["doc_id"]).collect()
    assert len(got) == 16 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[1] == by[2] == voter.prior
    assert quality.fit(docs, labels.limit(0)) is None and quality.fit(no_docs(spark), labels) is None
    assert {r.score for r in quality.classify(docs, None, ["doc_id"]).collect()} == {0.5}
    assert quality.classify(no_docs(spark), voter, ["doc_id"]).count() == 0
