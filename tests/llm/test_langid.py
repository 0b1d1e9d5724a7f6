import numpy as np
from pyspark.sql import functions as F

from strandweave.llm import langid, queries

from .data import edge_docs, no_docs


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op8_language_id(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    held = got.filter("held_out").join(docs, "doc_id").collect()
    assert got.count() == docs.count() and len(held) > 200
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.98
    assert all(0 <= r.score <= 1 for r in held)


def test_odd_rows(spark):
    docs = edge_docs(spark)
    net = langid.fit(docs)
    assert net.langs == ["de", "en"]
    got = langid.identify(docs, net, ["doc_id"]).collect()
    by = {r.doc_id: r.lang_pred for r in got if r.doc_id is not None}
    assert len(got) == 16 and all(by[i] == "und" for i in (1, 2, 3, 10))
    assert {r.lang_pred for r in got} <= {"de", "en", "und"} and by[6] == by[7] == "en"
    assert langid.fit(no_docs(spark)) is None
    assert {r.lang_pred for r in langid.identify(docs, None, ["doc_id"]).collect()} == {"und"}
    assert langid.identify(no_docs(spark), net, ["doc_id"]).count() == 0


def test_windows_cover_whole_texts():
    texts = [b"x" * 1000, b"", b"y" * 256]
    rows, owner, held = langid.windows_of(texts)
    assert owner.tolist() == [0] * 4 + [1, 2] and held.tolist() == [256, 256, 256, 232, 1, 256]
    # The bytes behind a window belong to the next one, so that no n-gram is lost.
    assert bytes(rows[0][256:]) == b"xxx" and bytes(rows[3][232:]) == bytes(27)


def random_net(rng, n_langs=3):
    tables = {w: rng.standard_normal((w, 256, langid.FILTERS)).astype(np.float64) for w in langid.WIDTHS}
    hidden = langid.FILTERS * len(langid.WIDTHS)
    return langid.ByteConvNet([f"l{i}" for i in range(n_langs)], tables, rng.standard_normal((hidden, n_langs)), rng.standard_normal(n_langs))


def plain_logits(net, text):
    """Filters one by one over every place of the first window; the bytes behind it belong to the n-grams."""
    data = text + bytes(langid.WINDOW + 3)
    out = net.bias.copy()
    for i, w in enumerate(langid.WIDTHS):
        for f in range(langid.FILTERS):
            best = max(
                sum(net.tables[w][o, data[at + o], f] if data[at + o] else langid.PAD for o in range(w))
                for at in range(langid.WINDOW)
            )
            out = out + max(best, 0.0) * net.dense[i * langid.FILTERS + f]
    return out


def test_logits_equal_a_plain_convolution():
    rng = np.random.default_rng(21)
    net = random_net(rng)
    single = langid.ByteConvNet(net.langs, {w: t.astype(np.float32) for w, t in net.tables.items()}, net.dense.astype(np.float32), net.bias.astype(np.float32))
    texts = [bytes(rng.integers(1, 256, n, dtype=np.uint8)) for n in (1, 3, 40, 255, 256, 258)]
    rows, owner, _ = langid.windows_of(texts)
    got = single.pairs().logits(rows)
    for k, text in enumerate(texts):
        assert np.allclose(got[np.flatnonzero(owner == k)[0]], plain_logits(net, text), rtol=1e-4, atol=1e-3)


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(22)
    net = random_net(rng)
    windows, _, _ = langid.windows_of([bytes(rng.integers(1, 256, n, dtype=np.uint8)) for n in (30, 200, 90, 256)])
    labels, weight = np.array([0, 1, 2, 1]), np.array([1.0, 0.5, 2.0, 1.5])
    _, grads = langid.loss_and_gradients(net, windows, labels, weight)
    for params, g in zip([*net.tables.values(), net.dense, net.bias], grads, strict=True):
        flat, gradient = params.reshape(-1), g.reshape(-1)
        touched = np.flatnonzero(gradient)
        for i in [*rng.choice(touched, min(12, len(touched)), replace=False), *rng.choice(len(flat), 3)]:
            old, sides = flat[i], []
            for step in (1e-6, -1e-6):
                flat[i] = old + step
                sides.append(langid.loss_and_gradients(net, windows, labels, weight)[0])
            flat[i] = old
            assert abs((sides[0] - sides[1]) / 2e-6 - gradient[i]) < 1e-5


def test_one_id_repeated_does_not_fill_the_driver(spark):
    docs = spark.range(60_000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("some words in a language number "), F.col("id").cast("string")).alias("text"), F.lit("xx").alias("lang"))
    more = spark.range(400).select((F.col("id") + 100).alias("doc_id"), F.concat(F.lit("andere Worte Nummer "), F.col("id").cast("string")).alias("text"), F.lit("yy").alias("lang"))
    how = ("doc_id", "text", "lang")
    rows = langid._sampled_windows(docs.unionByName(more), *how, 50, 3, 10_000).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in rows} == {"xx": 150, "yy": 50}
    rows = langid._sampled_windows(docs.unionByName(more), *how, 50, 3, 40).groupBy("lang").count().collect()
    assert {r.lang: r["count"] for r in rows} == {"xx": 20, "yy": 20}


def test_ties_and_very_long_texts():
    rng = np.random.default_rng(23)
    net = random_net(rng)
    net.dense[:], net.bias[:] = 0, 0
    long = "ein sehr langer Text " * 200_000
    names, scores = langid.predict_texts(["abc", long, None, "12"], net.pairs(), net.langs)
    assert names == ["l0", "l0", "und", "und"] and np.allclose(scores, [1 / 3, 1 / 3, 1, 1])
