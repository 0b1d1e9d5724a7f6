"""Language identification with a small byte convolutional network.

Filters of widths 2, 3 and 4 slide over the UTF-8 bytes of fixed-length windows; every filter's
largest response in a window passes a rectifier, and a softmax layer maps the pooled responses to
the learned languages. The network is trained in numpy on windows of labelled documents and then
applied to all windows of every text, many windows at a time; a text's scores are the mean of its
windows' probabilities, weighted by the bytes that each window holds, so that of a mixed text the
language of the larger part wins.

A filter is linear in the one-hot bytes below it, so its weights are a table (offset, byte ->
response). For application the tables of two neighbouring offsets are added up once into tables over
byte pairs, which halves the look-ups a byte.

Scale: one pass without a shuffle. The model is about 13 MB and the same size for any corpus.
Training reads a bounded sample: at most ``per_lang`` labelled documents of each language (the
smallest id hashes), ``windows`` windows of each, spread over the whole text, and ``most`` windows in
all, shared evenly by the languages. The bound holds on the executors, before anything is collected,
also where one id comes many times.

Defined cases: null text and texts without a letter: ``und`` with score 1.0; labels that are null
are not learned; if there is nothing to learn from, every text is ``und`` with score 0.0; ties go to
the language that sorts first; of very long texts all windows are scored, a stretch of texts at a time;
repeated rows are scored alike; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, map_texts, small_or_shuffled

UNDETERMINED = "und"
WIDTHS = (2, 3, 4)
FILTERS = 16
WINDOW = 256
#: Bounds of the training sample: documents of a language, windows of a document, windows in all.
PER_LANG = 500
WINDOWS = 3
MOST_WINDOWS = 200_000
#: Parts into which the rows of a language are dealt before the sample is drawn.
SALTS = 8
EPOCHS = 12
BATCH = 64
#: Windows that are convolved at once; their responses stay in cache.
CHUNK = 48
#: Response to the padding byte, so that no n-gram with padding wins a maximum.
PAD = np.float32(-1e3)


@dataclass
class ByteConvNet:
    langs: list[str]
    tables: dict[int, np.ndarray]  # width -> (width, 256, FILTERS)
    dense: np.ndarray  # (filters, languages)
    bias: np.ndarray

    def pairs(self) -> ByteConvPlan:
        t = {w: v.copy() for w, v in self.tables.items()}
        for v in t.values():
            v[:, 0, :] = PAD
        two = lambda w, o: (t[w][o][:, None, :] + t[w][o + 1][None, :, :]).reshape(65536, -1)
        return ByteConvPlan(two(2, 0), two(3, 0), t[3][2], two(4, 0), two(4, 2), self.dense, self.bias)


@dataclass
class ByteConvPlan:
    p2: np.ndarray
    p3: np.ndarray
    t3: np.ndarray
    p4: np.ndarray
    q4: np.ndarray
    dense: np.ndarray
    bias: np.ndarray

    def logits(self, windows: np.ndarray) -> np.ndarray:
        """``windows``: uint8, (n, WINDOW + 3); the last three bytes belong to the next window."""
        out = np.empty((len(windows), len(self.bias)), np.float32)
        for at in range(0, len(windows), CHUNK):
            x = windows[at : at + CHUNK].astype(np.intp)
            two = x[:, :-1] * 256 + x[:, 1:]
            r2 = _pool(self.p2[two[:, :WINDOW]])
            a = self.p3[two[:, :WINDOW]]
            a += self.t3[x[:, 2 : WINDOW + 2]]
            r3 = _pool(a)
            a = self.p4[two[:, :WINDOW]]
            a += self.q4[two[:, 2 : WINDOW + 2]]
            r4 = _pool(a)
            out[at : at + CHUNK] = np.maximum(np.hstack([r2, r3, r4]), 0) @ self.dense + self.bias
        return out


def _pool(a: np.ndarray) -> np.ndarray:
    """Maximum over axis 1, whose length is a power of two, by halves."""
    while a.shape[1] > 1:
        half = a.shape[1] // 2
        a = np.maximum(a[:, :half], a[:, half:])
    return a[:, 0]


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts: bytes (n, WINDOW + 3), text number and bytes held by each."""
    counts = np.array([max(1, -(-len(t) // WINDOW)) for t in texts])
    rows = np.zeros((int(counts.sum()), WINDOW + 3), np.uint8)
    held = np.full(len(rows), WINDOW, np.float32)
    at = 0
    for t, n in zip(texts, counts, strict=True):
        flat = np.zeros(n * WINDOW + WINDOW, np.uint8)
        flat[: len(t)] = np.frombuffer(t, np.uint8)
        rows[at : at + n] = np.lib.stride_tricks.sliding_window_view(flat, WINDOW + 3)[: n * WINDOW : WINDOW]
        held[at + n - 1] = max(1, len(t) - (n - 1) * WINDOW)
        at += n
    return rows, np.repeat(np.arange(len(texts)), counts), held


def loss_and_gradients(net: ByteConvNet, windows: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Weighted mean cross entropy of a batch, and its gradients by the net's tables, dense layer and
    bias. The gradient of max pooling reaches the winning n-gram alone."""
    x, n = windows.astype(np.intp), len(windows)
    rows, hidden, best = np.arange(n)[:, None], [], []
    for w in WIDTHS:
        v = net.tables[w].copy()
        v[:, 0, :] = PAD
        a = v[0][x[:, :WINDOW]]
        for o in range(1, w):
            a += v[o][x[:, o : o + WINDOW]]
        where = a.argmax(axis=1)
        best.append(where)
        hidden.append(np.take_along_axis(a, where[:, None, :], 1)[:, 0])
    pooled = np.hstack(hidden)
    act = np.maximum(pooled, 0)
    z = act @ net.dense + net.bias
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    loss = -float((weight * np.log(p[np.arange(n), labels])).sum()) / n
    p[np.arange(n), labels] -= 1
    p *= weight[:, None] / n
    grads = []
    back = (p @ net.dense.T) * (pooled > 0)
    for i, w in enumerate(WIDTHS):
        g = np.zeros_like(net.tables[w])
        part = back[:, i * FILTERS : (i + 1) * FILTERS]
        for o in range(w):
            np.add.at(g[o], (x[rows, best[i] + o], np.arange(FILTERS)[None, :]), part)
        # The padding byte has a response of its own, which is not learned.
        g[:, 0, :] = 0
        grads.append(g)
    return loss, [*grads, act.T @ p, p.sum(axis=0)]


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], seed: int = 7) -> ByteConvNet:
    """Adam on the cross entropy."""
    rng = np.random.default_rng(seed)
    n_out, n_hid = len(langs), FILTERS * len(WIDTHS)
    net = ByteConvNet(
        langs,
        {w: (rng.standard_normal((w, 256, FILTERS)) * 0.3).astype(np.float32) for w in WIDTHS},
        (rng.standard_normal((n_hid, n_out)) * 0.3).astype(np.float32),
        np.zeros(n_out, np.float32),
    )
    params = [*net.tables.values(), net.dense, net.bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    # Languages weigh alike, whatever their share of the sample.
    weight = 1 / np.maximum(np.bincount(labels, minlength=n_out), 1)
    weight = (weight / (weight[labels]).mean())[labels].astype(np.float32)
    step, rate = 0, 0.02
    for epoch in range(EPOCHS):
        if epoch >= EPOCHS * 2 // 3:
            rate = 0.005
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            _, grads = loss_and_gradients(net, windows[pick], labels[pick], weight[pick])
            step += 1
            for q, g, m, s in zip(params, grads, first, second, strict=True):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                q -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


def _sampled_windows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int, windows: int, most: int) -> DataFrame:
    """``lang, window`` of the sampled documents: at most ``windows`` a document, evenly spread."""
    labelled = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("h"))

    def least(rows: DataFrame, n: Column | int, salt: Column, *order) -> DataFrame:
        # First among the rows of one salt: a language of most rows is not one task's work.
        for keys in (["lang", salt], ["lang"]):
            place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
            rows = rows.withColumn("r", place).filter(F.col("r") <= n).drop("r")
        return rows

    salt = lambda h: F.pmod(h, F.lit(SALTS))
    ids = least(labelled.filter("lang is not null and id is not null"), per_lang, salt(F.col("h")), "h", "id").select("id", "lang").distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    # Counted: without the hint all texts would be shuffled for a few thousand of them.
    ids = cut_lineage(ids)
    n_langs = ids.select("lang").distinct().count()
    few = small_or_shuffled(ids)
    chosen = texts.filter("text is not null").join(few, ["id", "lang"], "left_semi").select("lang", "text")
    schema = pa.schema([("lang", pa.string()), ("window", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, found = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not has_letter(text):
                    continue
                rows, _, _ = windows_of([text.encode("utf-8")])
                for i in sorted({len(rows) * k // windows for k in range(windows)}):
                    langs.append(lang)
                    found.append(rows[i].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary())], schema=schema)

    cut = chosen.mapInArrow(run, "lang string, window binary").withColumn("h", F.xxhash64("window"))
    # A repeated id brings more rows than it counts for; what is collected is bounded here.
    quota = max(1, min(per_lang * windows, most // max(1, n_langs)))
    return least(cut, quota, salt(F.shiftright("h", 8)), "h", "window").select("lang", "window")


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_lang: int = PER_LANG,
    windows: int = WINDOWS,
    most: int = MOST_WINDOWS,
) -> ByteConvNet | None:
    """Train on a bounded sample; None if no document has both a letter and a label."""
    got = _sampled_windows(docs, id_col, text_col, lang_col, per_lang, windows, most).toArrow()
    rows = sorted(zip(got.column("lang").to_pylist(), got.column("window").to_pylist(), strict=True))
    if not rows:
        return None
    langs = sorted({lang for lang, _ in rows})
    at = {lang: i for i, lang in enumerate(langs)}
    found = np.frombuffer(b"".join(w for _, w in rows), np.uint8).reshape(-1, WINDOW + 3)
    return train(found, np.array([at[lang] for lang, _ in rows]), langs)


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def predict_texts(texts: list[str | None], plan: ByteConvPlan | None, langs: list[str]):
    """Languages and scores of the texts."""
    names, scores = [UNDETERMINED] * len(texts), [1.0] * len(texts)
    there = [i for i, t in enumerate(texts) if has_letter(t)]
    if plan is None:
        for i in there:
            scores[i] = 0.0
        return names, scores
    # Long texts go alone, so that the windows at hand stay few.
    group: list[int] = []
    size = 0

    def flush():
        if not group:
            return
        rows, owner, held = windows_of([texts[i].encode("utf-8") for i in group])
        z = plan.logits(rows)
        votes = np.exp(z - z.max(axis=1, keepdims=True))
        votes *= (held / votes.sum(axis=1))[:, None]
        p = np.zeros((len(group), z.shape[1]))
        np.add.at(p, owner, votes)
        p /= np.bincount(owner, held, len(group))[:, None]
        for i, best, row in zip(group, p.argmax(axis=1), p, strict=True):
            names[i], scores[i] = langs[best], float(row[best])
        group.clear()

    for i in there:
        if size + len(texts[i]) > 1 << 20:
            flush()
            size = 0
        group.append(i)
        size += len(texts[i])
    flush()
    return names, scores


def identify(
    docs: DataFrame,
    net: ByteConvNet | None,
    keep: list[str],
    text_col: str = "text",
    keep_text: bool = False,
) -> DataFrame:
    """The columns in ``keep`` of every row, with ``lang_pred`` and ``score``."""
    model = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        net = model.value
        plan = net.pairs() if net else None
        return lambda texts: predict_texts(texts, plan, net.langs if net else [])

    out = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_texts(docs, make, keep, text_col, out, keep_text)
