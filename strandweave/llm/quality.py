"""Quality by nearest-neighbour voting over latent-semantic vectors.

Terms of a text are pairs of neighbouring byte classes (letters in lower and upper case, digits, white
space, and each common sign), line shapes, and hashed four-byte sequences in lower case. Their
logarithmic counts, weighted by inverse document frequency and scaled to unit length, are projected
onto the leading singular directions of the labelled documents (latent-semantic analysis); term pairs
and sequences keep a share each. The projected labelled vectors are broadcast. Every document meets
all of them: cosines are exact products of a block of documents with the matrix of labelled vectors,
and the ``NEIGHBOURS`` nearest vote with weights that grow with their similarity.

Scale: one pass without a shuffle. The model is bounded by ``MOST_LABELLED`` vectors of ``DIMS``
numbers (1 MB) and the projection (0.5 MB), the same size for any corpus. It is fitted on a bounded
sample, the ``MOST_LABELLED`` labelled documents with the smallest id hashes; whole texts are read in
training and scoring.

Defined cases: null and empty texts have no terms; they get the share of good labels among the sample
as their score; without labels every score is 0.5; an id labelled twice counts twice; ties among
neighbours go to the earlier id; repeated rows are scored alike; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts

MOST_LABELLED = 4096
DIMS = 64
NEIGHBOURS = 15
#: Similarity is raised to this power in the vote.
SHARPNESS = 8
HASHED = 512
#: Bytes of a text that are turned into terms at once.
STRETCH = 1 << 20

# Byte classes: lower and other letters 0, upper 1, digits 2, space 3, line end 4, then each sign its own.
SIGNS = b"#*$%&|<>!?.,;:-_=+/()[]{}@\"'"
N_CLASSES = 5 + len(SIGNS) + 1


def _class_table() -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[:128] = N_CLASSES - 1
    table[ord("a") : ord("z") + 1] = 0
    table[ord("A") : ord("Z") + 1] = 1
    table[ord("0") : ord("9") + 1] = 2
    table[[32, 9]] = 3
    table[[10, 13]] = 4
    for i, c in enumerate(SIGNS):
        table[c] = 5 + i
    return table


CLASS = _class_table()
N_PAIRS = N_CLASSES * N_CLASSES
N_TERMS = N_PAIRS + HASHED
_LOWER = bytes(range(256)).lower()


def terms(text: str | None) -> np.ndarray:
    """Counts of all terms of the whole text."""
    data = (text or "").encode("utf-8")
    out = np.zeros(N_TERMS, np.int64)
    low = data.translate(_LOWER)
    for at in range(0, len(data), STRETCH):
        # A stretch overlaps the next by three bytes, so that no sequence is lost or counted twice.
        x = CLASS[np.frombuffer(data, np.uint8, min(STRETCH + 1, len(data) - at), at)]
        out[:N_PAIRS] += np.bincount(x[:-1] * N_CLASSES + x[1:], minlength=N_PAIRS)
        b = np.frombuffer(low, np.uint8, min(STRETCH + 3, len(low) - at), at).astype(np.uint32)
        if len(b) >= 4:
            four = b[:-3] | b[1:-2] << 8 | b[2:-1] << 16 | b[3:] << 24
            out[N_PAIRS:] += np.bincount((four * np.uint32(2654435761)) >> np.uint32(23), minlength=HASHED)
    return out


def damped(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weighted terms; pairs and hashed sequences are scaled to the same length."""
    x = np.log1p(counts.astype(np.float32)) * idf
    for part in (slice(0, N_PAIRS), slice(N_PAIRS, N_TERMS)):
        norm = np.linalg.norm(x[:, part], axis=1, keepdims=True)
        x[:, part] /= np.where(norm > 0, norm, 1)
    return x


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


@dataclass
class Voter:
    idf: np.ndarray
    centre: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        return _unit((damped(counts, self.idf) - self.centre) @ self.projection)

    def score(self, counts: np.ndarray) -> np.ndarray:
        cosines = self.project(counts) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        # Equal cosines: the earlier labelled vector, by a stable sort of what is not below the k-th.
        limit = np.partition(cosines, cosines.shape[1] - k, axis=1)[:, -k]
        out = np.empty(len(cosines))
        for i, row in enumerate(cosines):
            near = np.flatnonzero(row >= limit[i])
            near = near[np.argsort(-row[near], kind="stable")][:k]
            weight = np.maximum(row[near], 1e-6).astype(np.float64) ** SHARPNESS
            out[i] = (weight * self.labels[near]).sum() / weight.sum()
        out[counts.sum(axis=1) == 0] = self.prior
        return np.clip(out, 0, 1)


def leading_directions(x: np.ndarray, dims: int, rounds: int = 5) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from fixed random directions."""
    rng = np.random.default_rng(11)
    basis = rng.standard_normal((x.shape[1], min(dims + 16, x.shape[1]))).astype(np.float32)
    for _ in range(rounds):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    _, _, rows = np.linalg.svd(x @ basis, full_matrices=False)
    return np.ascontiguousarray(basis @ rows[:dims].T)


def fit_counts(counts: np.ndarray, labels: np.ndarray) -> Voter:
    """Latent-semantic vectors of labelled documents, from their term counts."""
    idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    x = damped(counts, idf)
    centre = x.mean(axis=0)
    x -= centre
    projection = leading_directions(x, min(DIMS, *x.shape))
    return Voter(idf, centre, projection, _unit(x @ projection), labels.astype(np.float64), float(labels.mean()))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = MOST_LABELLED) -> Voter | None:
    """Fit on the labelled documents with the smallest id hashes; None without any."""
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter("id is not null and label is not null")
    marks = marks.join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
    sample = marks.orderBy(F.xxhash64("id"), "id", "label").limit(most)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def make():
        return lambda batch: [[terms(t).astype("<u4").tobytes() for t in batch]]

    # At most `most` rows: small by their number.
    chosen = texts.join(F.broadcast(sample), "id")
    rows = map_texts(chosen, make, ["id", "label"], "text", T.StructType([T.StructField("counts", T.BinaryType())]))
    got = rows.orderBy("id", "label", "counts").limit(most).toArrow()
    if not got.num_rows:
        return None
    counts = np.frombuffer(b"".join(got.column("counts").to_pylist()), "<u4").reshape(-1, N_TERMS)
    return fit_counts(counts, np.array(got.column("label").to_pylist()))


def classify(docs: DataFrame, voter: Voter | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns in ``keep`` of every row, ``score`` and ``predicted``."""
    model = docs.sparkSession.sparkContext.broadcast(voter)

    def make():
        voter = model.value

        def apply(texts):
            if voter is None:
                return [[0.5] * len(texts)]
            return [voter.score(np.stack([terms(t) for t in texts])).tolist()]

        return apply

    scored = map_texts(docs, make, keep, text_col, T.StructType([T.StructField("score", T.DoubleType())]))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
