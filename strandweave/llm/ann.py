"""Nearest neighbours by largest inner product: a block matrix join over int8 tiles.

Vectors are packed into full blocks, and the queries among them into blocks of their own. The blocks are
laid on a grid: shares of the queries by shares of the candidates. A cell of the grid holds its share of
the queries and meets its candidate blocks one after the other, each in a tile. A tile multiplies the
int8 codes (exactly: products of int8 numbers are summed in float32 within its 24 bits, a stretch
of dimensions at a time), scales them back, and bounds the quantisation error by Cauchy-Schwarz from
the residuals' norms, so that each pair has a lower and an upper bound. Pairs whose upper bound
reaches the k-th largest lower bound of the tile, and the k-th best product of the tiles before it,
survive; only they are recomputed in double precision, on the original vectors. A cell returns at most
k rows a query, and heaps merge the cells' lists. Where a bound is not finite the pair is recomputed.
The result is exact.

Scale: work is queries times candidates, cut into cells that any executor can run. A candidate block is
sent once to each share of queries and a query block once to each share of candidates, so no block is
sent more often than the grid is long. A cell's memory is its share of the queries (``SHARE`` numbers),
k rows for each, one candidate block and a strip of products. Blocks hold rows in the order in which
they are read and shares are dealt by block, so that no key and no group of equal vectors makes one large.

Defined cases: null, empty and zero vectors, and those holding null or non-finite components, take no
part; vectors are compared with those of their own length, however long; ties go to the smaller id (null
last), then to the earlier row; a product that is no number (infinities that cancel out) comes last; rows
with one id are candidates of their own, only the query's own row is left out; with fewer than k
candidates all come back; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage

K = 20
EVERY = 20
#: Rows of a block, and numbers of its vectors, at most.
BLOCK, BLOCK_NUMBERS = 4096, 1 << 20
#: Numbers of the query vectors that a cell of the grid holds (about).
SHARE = 1 << 23
#: Candidates of a cell (about): bounds the work of a task.
CELL_ROWS = 1 << 20
#: Queries of a strip of a tile.
STRIP = 128
#: Dimensions whose int8 products add up exactly in float32: 1024 * 127 * 127 < 2**24.
EXACT_DIMS = 1024
#: Room for the rounding of the bounds themselves, as a share of the norms' product.
ROUNDING = 1e-6
_NO_ID = np.iinfo(np.int64).max

_BLOCKS = "kind string, block long, dim int, size int, uid binary, ids binary, vectors binary"


def _pack(every: int, number_type: str):
    """Blocks of the valid vectors, candidates and queries; numbers are stored as wide as they came."""
    schema = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("dim", pa.int32()), ("size", pa.int32()), ("uid", pa.binary()), ("ids", pa.binary()), ("vectors", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        number_bytes = np.dtype(number_type)
        held: dict[tuple[str, int], list] = {}
        number, row = 0, 0

        def block(kind: str, dim: int) -> pa.RecordBatch:
            nonlocal number
            uid, ids, vectors = (np.concatenate(x) for x in zip(*held.pop((kind, dim)), strict=True))
            number += 1
            values = [[kind], [(part << 32) + number], [dim], [len(uid)], [uid.astype("<i8").tobytes()], [ids.astype("<i8").tobytes()], [vectors.astype(number_bytes).tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(at, BLOCK)
                ids, lists = piece.column(0), piece.column(1)
                uid = (part << 40) + row + np.arange(len(lists))
                row += len(lists)
                sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null: nan
                ends = np.cumsum(sizes)
                named = ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False)
                is_query = (named % every == 0) & ids.is_valid().to_numpy(zero_copy_only=False)
                for dim in np.unique(sizes[sizes > 0]).tolist():
                    of = np.flatnonzero(sizes == dim)
                    vectors = flat[(ends[of] - dim)[:, None] + np.arange(dim)]
                    good = np.isfinite(vectors).all(axis=1) & (vectors != 0).any(axis=1)
                    of, vectors = of[good], vectors[good]
                    most = max(1, min(BLOCK, BLOCK_NUMBERS // dim))
                    for kind, mask in (("c", np.ones(len(of), bool)), ("q", is_query[of])):
                        for cut in range(0, int(mask.sum()), most):
                            some = slice(cut, cut + most)
                            held.setdefault((kind, dim), []).append((uid[of][mask][some], named[of][mask][some], vectors[mask][some]))
                            if sum(len(x[0]) for x in held[kind, dim]) >= most:
                                yield block(kind, dim)
        for kind, dim in list(held):
            yield block(kind, dim)

    return run


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes (as float32), scales, norms of the coded vectors, norms of the residuals."""
    x = x.astype(np.float64)
    scale = np.abs(x).max(axis=1) / 127
    scale = np.where(scale > 0, scale, np.finfo(np.float64).tiny)
    codes = np.clip(np.rint(x / scale[:, None]), -127, 127)
    coded = codes * scale[:, None]
    return codes.astype(np.float32), scale, np.linalg.norm(coded, axis=1), np.linalg.norm(x - coded, axis=1)


def int8_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 codes."""
    out = None
    for at in range(0, a.shape[1], EXACT_DIMS):
        part = a[:, at : at + EXACT_DIMS] @ b[:, at : at + EXACT_DIMS].T
        out = part if out is None else out.astype(np.float64) + part
    return out


def exact_products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row by row, in double precision, adding up the dimensions in order."""
    q, c = q.astype(np.float64), c.astype(np.float64)
    total = np.zeros(len(q))
    with np.errstate(all="ignore"):
        for d in range(q.shape[1]):
            total += q[:, d] * c[:, d]
    return total


def order_key(score: np.ndarray) -> np.ndarray:
    """What a score is ranked by: no number comes last."""
    return np.where(np.isnan(score), -np.inf, score)


class Best:
    """The k nearest of each query so far."""

    def __init__(self, uid: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.uid, self.ids, self.vectors, self.k = uid, ids, vectors, k
        self.codes, self.scale, self.norm, self.rest = quantise(vectors)
        # Sorted by query row, then nearest first.
        self.row = np.empty(0, np.int64)
        self.other, self.other_id, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    def limits(self) -> np.ndarray:
        """By query, the k-th best score; -inf while there are fewer."""
        out = np.full(len(self.uid), -np.inf)
        count = np.bincount(self.row, minlength=len(self.uid))
        full = np.flatnonzero(count == self.k)
        out[full] = order_key(self.score[(np.cumsum(count) - 1)[full]])
        return out

    def meet(self, uid: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """One tile: the candidates of a block."""
        k = self.k
        codes, scale, norm, rest = quantise(vectors)
        limits = self.limits()
        found = [(self.row, self.other, self.other_id, self.score)]
        for at in range(0, len(self.uid), STRIP):
            rows = slice(at, at + STRIP)
            with np.errstate(all="ignore"):
                near = int8_products(self.codes[rows], codes) * (self.scale[rows, None] * scale)
                # |q.c - q'.c'| <= |q'| |c - c'| + |q - q'| (|c'| + |c - c'|)
                error = self.norm[rows, None] * rest + self.rest[rows, None] * (norm + rest)
                error += ROUNDING * (self.norm[rows] + self.rest[rows])[:, None] * (norm + rest)
                low, high = near - error, near + error
            # A bound that is no finite number says nothing.
            low[~np.isfinite(low)] = -np.inf
            high[~np.isfinite(high)] = np.inf
            own = self.uid[rows, None] == uid
            low[own] = -np.inf
            least = limits[rows]
            if len(uid) > k:
                least = np.maximum(least, np.partition(low, len(uid) - k, axis=1)[:, len(uid) - k])
            keep = high >= least[:, None]
            keep[own] = False
            i, j = np.nonzero(keep)
            score = np.empty(len(i))
            some = max(1, BLOCK_NUMBERS // vectors.shape[1])
            for cut in range(0, len(i), some):
                part = slice(cut, cut + some)
                score[part] = exact_products(self.vectors[at + i[part]], vectors[j[part]])
            found.append((at + i, uid[j], ids[j], score))
        row, other, other_id, score = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((other, other_id, -order_key(score), row))
        row = row[order]
        kept = np.arange(len(row)) - np.searchsorted(row, row) < k
        order = order[kept]
        self.row, self.other, self.other_id, self.score = row[kept], other[order], other_id[order], score[order]


def _cells(k: int, number_type: str):
    """The k nearest of each cell's queries; rows are sorted by cell and dimensions, queries first."""
    names = ("q_uid", "q_id", "uid", "id", "score")
    schema = pa.schema([(n, pa.float64() if n == "score" else pa.int64()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, queries, best = None, [], None

        def result() -> pa.RecordBatch:
            values = (best.uid[best.row], best.ids[best.row], best.other, best.other_id, best.score)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in values], schema=schema)

        for batch in batches:
            for r in range(batch.num_rows):
                cell, kind, dim, uid, ids, vectors = (batch.column(i)[r].as_py() for i in range(batch.num_columns))
                uid, ids = np.frombuffer(uid, "<i8"), np.frombuffer(ids, "<i8")
                vectors = np.frombuffer(vectors, number_type).reshape(-1, dim)
                if now != (cell, dim):
                    if best:
                        yield result()
                    now, queries, best = (cell, dim), [], None
                if kind == "q":
                    queries.append((uid, ids, vectors))
                    continue
                if queries:
                    best = Best(*(np.concatenate(x) for x in zip(*queries, strict=True)), k)
                    queries = []
                if best:
                    best.meet(uid, ids, vectors)
        if best:
            yield result()

    return run


def _merge(k: int):
    """Heaps of k rows a query over rows that are sorted by query."""
    schema = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heap: list = []
        now, out = None, []

        def close():
            # Worst first in the heap; best first in the result.
            for rank, (_, vec, _, score) in enumerate(sorted(heap, key=lambda e: e[:3], reverse=True), 1):
                out.append((now[1], rank, None if vec == -_NO_ID else -vec, score))
            heap.clear()

        def flush():
            columns = zip(*out, strict=True) if out else ([], [], [], [])
            made = pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            out.clear()
            return made

        for batch in batches:
            for uid, query, other, vec, score in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != (uid, query):
                    if now:
                        close()
                    now = (uid, query)
                # Ranked by the first three; no two are equal in them.
                entry = (-math.inf if math.isnan(score) else score, -vec, -other, score)
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry[:3] > heap[0][:3]:
                    heapq.heapreplace(heap, entry)
            yield flush()
        if now:
            close()
        yield flush()

    return run


def search(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest of every row whose id is divisible by ``every``."""
    number_type = "<f4" if isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType) else "<f8"
    wide = "array<float>" if number_type == "<f4" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(wide).alias("v"))
    # Few partitions where the rows are few, so that blocks get full.
    part = max(1, -(-rows.count() // BLOCK))
    blocks = cut_lineage(rows.coalesce(part).mapInArrow(_pack(every, number_type), _BLOCKS))
    is_query = F.col("kind") == "q"
    sums = blocks.agg(F.sum(F.when(is_query, F.col("size") * F.col("dim").cast("long"))), F.sum(F.when(~is_query, F.col("size"))), F.count_if(~is_query)).first()
    numbers, candidates, n_blocks = (x or 0 for x in sums)
    # The grid: shares of the queries by shares of the candidates.
    high = max(1, -(-numbers // SHARE))
    cells = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wide = max(1, min(n_blocks, max(-(-cells // high), -(-candidates // CELL_ROWS))))
    place = (F.shiftright("block", 32) + F.col("block").bitwiseAND(F.lit((1 << 32) - 1))).cast("long")
    every_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    payload = ["kind", "block", "dim", "uid", "ids", "vectors"]
    left = blocks.filter(is_query).select((place % high).alias("i"), every_of(wide).alias("j"), *payload)
    right = blocks.filter(~is_query).select(every_of(high).alias("i"), (place % wide).alias("j"), *payload)
    laid = left.unionByName(right).withColumn("cell", F.col("i") * wide + F.col("j")).drop("i", "j")
    # Queries ('q') before candidates ('c').
    spread = laid.repartition("cell").sortWithinPartitions("cell", "dim", F.desc("kind"), "block")
    near = spread.select("cell", "kind", "dim", "uid", "ids", "vectors").mapInArrow(_cells(k, number_type), "q_uid long, q_id long, uid long, id long, score double")
    return near.repartition("q_uid").sortWithinPartitions("q_uid").mapInArrow(_merge(k), "query_id long, rank int, vec_id long, score double")


ORACLE_SQL = """
with valid as (
  select row_number() over () as r, vec_id, cast(embedding as double[]) as v from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored as (
  select q.r as qr, q.vec_id as query_id, c.vec_id, c.r,
    list_reduce(list_prepend(0.0::double, list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), lambda a, b: a + b) as score
  from valid q join valid c on q.r <> c.r and len(q.v) = len(c.v) where q.vec_id % 20 = 0)
select query_id, (row_number() over (partition by qr order by score desc, vec_id nulls last, r))::int as rank, vec_id, score
from scored qualify row_number() over (partition by qr order by score desc, vec_id nulls last, r) <= 20
"""
