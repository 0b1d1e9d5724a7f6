"""Best-fit packing of documents into fixed-length sequences by a grouping genetic algorithm.

A document is tokenized, closed with an end id, and cut into pieces only if it is longer than a
sequence. The pieces are dealt evenly to shards of at most ``SHARD`` pieces. Each shard is solved by
``ISLANDS`` islands at once, each a population of packings. In a generation a child takes over whole
well-filled bins of one parent into the bins of the other, bins of the other that hold one of the
same pieces are removed, and the pieces displaced by that are put back: first a displaced piece takes the
place of a smaller one wherever that fills a bin better, then what is loose is best-fit, largest first.
After each of ``EPOCHS`` epochs the best packing of an island moves to the next one. A shard is done
early only when no packing can have fewer bins (see :func:`least_bins`); the generations that it took are
returned with its pieces. Bins of the first pass that are filled below
``LOOSE`` are opened, and their pieces are dealt to new shards and packed once more, so that the
worst bin of a shard isn't left as it is.

Scale: texts are tokenized once and go no further; a piece is a row of a few numbers. Shards are
dealt round robin, so that no key, source or size of a document makes one large. A shard has a
fixed size, and so have the rows that move between epochs.

Defined cases: null and empty texts are one piece with the end id alone; a document of exactly the
capacity is one piece, a very long one as many as it needs; ties of lengths go by the order in the shard;
repeated rows are packed each on their own; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import Many, cut_lineage, map_texts
from .tokens import word_ids

CAPACITY = 4096
END_ID = 1
SHARD = 2048
ISLANDS = 2
EPOCHS = 3
GENERATIONS = 20
POPULATION = 6
#: Bins filled below this share are opened for the second pass.
LOOSE = 0.995

PIECE_FIELDS = T.StructType(
    [
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
)


def pieces(docs: DataFrame, vocabulary: str, keep: list[str], text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: the columns in ``keep``, piece, start, length, ids_crc32."""
    end = END_ID.to_bytes(4, "little")

    def make():
        ids_of = word_ids(vocabulary)

        def apply(texts):
            rows, number, start, length, crc = [], [], [], [], []
            for row, found in enumerate(ids_of.many([t or "" for t in texts])):
                ids = memoryview(found + end)
                for k, at in enumerate(range(0, len(ids), capacity * 4)):
                    part = ids[at : at + capacity * 4]
                    rows.append(row)
                    number.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            return Many(rows, [number, start, length, crc])

        return apply

    return map_texts(docs, make, keep, text_col, PIECE_FIELDS)


class Packing:
    """Bins as lists of piece numbers, with their free space."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins: dict[int, list[int]] = {}
        self.free: dict[int, int] = {}
        self.order: list[tuple[int, int]] = []  # (free space, bin), sorted
        self.next = 0

    def add(self, items: list[int]) -> None:
        b, self.next = self.next, self.next + 1
        self.bins[b] = items
        self.free[b] = self.capacity - sum(self.lengths[i] for i in items)
        insort(self.order, (self.free[b], b))

    def best_fit(self, items) -> None:
        """Put each item, in the order given, where it leaves the least space."""
        for i in items:
            size = self.lengths[i]
            at = bisect_left(self.order, (size, -1))
            if at == len(self.order):
                self.add([i])
                continue
            space, b = self.order.pop(at)
            self.bins[b].append(i)
            self.free[b] = space - size
            insort(self.order, (space - size, b))

    def refit(self, loose: list[int]) -> None:
        """Put loose pieces into the bins: each bin, the emptiest first, gives up a piece for the loose
        one that fills it best, while there is one; what is loose then is best-fit, largest first."""
        pool = sorted((self.lengths[i], -i) for i in loose)
        for b in sorted(self.bins, key=lambda k: -self.free[k]):
            items, space = self.bins[b], self.free[b]
            while space and pool:
                best = (0, 0, 0)
                for k, i in enumerate(items):
                    size = self.lengths[i]
                    at = bisect_right(pool, (size + space, 1)) - 1
                    if at >= 0 and pool[at][0] - size > best[0]:
                        best = (pool[at][0] - size, k, at)
                gain, k, at = best
                if not gain:
                    break
                out, items[k] = items[k], -pool.pop(at)[1]
                insort(pool, (self.lengths[out], -out))
                space -= gain
            self.free[b] = space
        self.order = sorted((space, b) for b, space in self.free.items())
        self.best_fit([-i for _, i in reversed(pool)])

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first, then fuller ones."""
        return -len(self.bins), sum((1 - f / self.capacity) ** 2 for f in self.free.values())

    def groups(self) -> list[list[int]]:
        return list(self.bins.values())

    def codes(self) -> bytes:
        out = np.zeros(len(self.lengths), np.int32)
        for k, items in enumerate(self.bins.values()):
            out[items] = k
        return out.tobytes()


def from_codes(codes: bytes, lengths: list[int], capacity: int) -> Packing:
    of = np.frombuffer(codes, np.int32)
    order = np.argsort(of, kind="stable")
    cuts = np.flatnonzero(np.diff(of[order])) + 1
    out = Packing(lengths, capacity)
    for items in np.split(order, cuts) if len(order) else []:
        out.add(items.tolist())
    return out


def crossover(a: Packing, b: Packing, rng: np.random.Generator) -> Packing:
    """Whole well-filled bins of ``b`` go into ``a``; the rest of the bins that clash is put back."""
    full = sorted(b.bins, key=lambda k: (b.free[k], k))
    most = max(1, int(len(full) * rng.uniform(0.1, 0.5)))
    inject = [b.bins[k] for k in full[:most] if rng.random() < 0.8] or [b.bins[full[0]]]
    taken = {i for items in inject for i in items}
    child = Packing(a.lengths, a.capacity)
    for items in inject:
        child.add(list(items))
    displaced = []
    for items in a.bins.values():
        if taken.isdisjoint(items):
            child.add(list(items))
        else:
            displaced += [i for i in items if i not in taken]
    child.refit(displaced)
    return child


def mutate(p: Packing, rng: np.random.Generator) -> Packing:
    """Open the emptiest bins and a few others, and put their pieces back."""
    order = sorted(p.bins, key=lambda k: (-p.free[k], k))
    some = max(2, len(order) // 20)
    opened = set(order[:some]) | set(rng.choice(order, min(some, len(order)), replace=False).tolist())
    out, loose = Packing(p.lengths, p.capacity), []
    for k, items in p.bins.items():
        if k in opened:
            loose += items
        else:
            out.add(list(items))
    out.refit(loose)
    return out


def least_bins(lengths: np.ndarray, capacity: int) -> int:
    """A number of bins that no packing goes below: for every size a, pieces over half the capacity need
    bins of their own, and the pieces from a to half have only the room that those of at most capacity - a
    leave."""
    if not len(lengths):
        return 0
    x = np.sort(lengths).astype(np.int64)
    upto = np.r_[0, np.cumsum(x)]
    half = int(np.searchsorted(x, capacity // 2, side="right"))
    a = np.unique(np.r_[1, x[:half]])
    large = np.searchsorted(x, capacity - a, side="right")  # from here on, nothing of size a fits beside
    room = np.maximum(large - half, 0) * capacity - (upto[np.maximum(large, half)] - upto[half])
    small = upto[half] - upto[np.searchsorted(x, a)]
    return int((len(x) - half + np.maximum(0, -(-(small - room) // capacity))).max())


def evolve(lengths: np.ndarray, elites: list[bytes], seed: list[int], capacity: int, generations: int) -> tuple[Packing, int]:
    """One epoch of one island: its best packing and the generations that it took."""
    sizes = lengths.tolist()
    rng = np.random.default_rng(seed)
    least = least_bins(lengths, capacity)
    crowd = [from_codes(e, sizes, capacity) for e in elites]
    largest = np.lexsort((np.arange(len(sizes)), -lengths))
    while len(crowd) < POPULATION:
        if len(crowd) and -crowd[0].fitness()[0] == least:
            break
        order = largest if not crowd else np.argsort(-lengths * rng.uniform(0.8, 1.0, len(sizes)), kind="stable")
        p = Packing(sizes, capacity)
        p.best_fit(order.tolist())
        crowd.append(p)
    taken = 0
    while taken < generations:
        crowd.sort(key=Packing.fitness, reverse=True)
        if len(crowd[0].bins) <= least or len(crowd) < 2:
            break
        taken += 1
        x, y = rng.choice(len(crowd), 2, replace=False)
        crowd[-1] = mutate(crossover(crowd[min(x, y)], crowd[max(x, y)], rng), rng)
    return max(crowd, key=Packing.fitness), taken


def _shards(rows: DataFrame, shard: int) -> DataFrame:
    """Rows of up to ``shard`` pieces as lists; ``shard`` (long) numbers them."""
    schema = T.StructType(
        [T.StructField("shard", T.LongType()), *(T.StructField(f.name, T.ArrayType(f.dataType)) for f in rows.schema.fields)]
    )
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number, held = TaskContext.get().partitionId() << 22, 0, None

        def row(table):
            lists = [pa.ListArray.from_arrays(pa.array([0, len(table)], pa.int32()), c.combine_chunks()) for c in table.columns]
            lists = [x.cast(f.type) for x, f in zip(lists, list(arrow)[1:], strict=True)]
            return pa.RecordBatch.from_arrays([pa.array([first + number], pa.int64()), *lists], schema=arrow)

        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            while len(held) >= shard:
                yield row(held.slice(0, shard))
                held, number = held.slice(shard), number + 1
        if held is not None and len(held):
            yield row(held)

    return rows.mapInArrow(run, schema)


def _epoch(islands: DataFrame, epoch: int, capacity: int, generations: int) -> DataFrame:
    schema = pa.schema([("shard", pa.int64()), ("island", pa.int32()), ("length", pa.list_(pa.int64())), ("elite", pa.binary()), ("bins", pa.int64()), ("filled", pa.float64()), ("generations", pa.int64())])
    lists = [c for c in ("elite", "guest") if c in islands.columns]
    cols = ["shard", "island", "length", *lists, "generations"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                shard, island = one.column(0)[0].as_py(), one.column(1)[0].as_py()
                lengths = one.column(2).flatten().to_numpy()
                elites = [one.column(3 + k)[0].as_py() for k in range(len(lists))]
                best, taken = evolve(lengths, elites, [shard & 0x7FFFFFFF, island, epoch], capacity, generations)
                bins, filled = best.fitness()
                yield pa.RecordBatch.from_arrays([one.column(0), one.column(1), one.column(2).cast(schema.field(2).type), pa.array([best.codes()], pa.binary()), pa.array([-bins], pa.int64()), pa.array([filled]), pa.array([one.column(len(cols) - 1)[0].as_py() + taken])], schema=schema)

    return islands.select(*cols).mapInArrow(run, "shard long, island int, length array<long>, elite binary, bins long, filled double, generations long")


def _solve(shards: DataFrame, capacity: int) -> DataFrame:
    """``shard, elite, generations``: the best packing of each shard, and the generations of all islands."""
    islands = shards.select("shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"), "length", F.lit(0).cast("long").alias("generations"))
    for epoch in range(EPOCHS):
        islands = _epoch(islands, epoch, capacity, GENERATIONS)
        if epoch + 1 < EPOCHS:
            # The elite of each island moves to the next, round the ring.
            ring = Window.partitionBy("shard").orderBy("island")
            whole = Window.partitionBy("shard").orderBy("island").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            guest = F.coalesce(F.lag("elite").over(ring), F.last("elite").over(whole))
            islands = islands.withColumn("guest", guest).select("shard", "island", "length", "elite", "guest", "generations")
    order = F.struct("bins", -F.col("filled"), "island")
    return islands.groupBy("shard").agg(F.min_by("elite", order).alias("elite"), F.sum("generations").alias("generations"))


def _placed(shards: DataFrame, best: DataFrame, columns: T.StructType, capacity: int, turn: int) -> DataFrame:
    """The pieces again, with ``sequence_id, offset, generations, filled``."""
    extra = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("generations", T.LongType()), T.StructField("filled", T.LongType())]
    schema = T.StructType([*columns.fields, *extra])
    arrow = to_arrow_schema(schema)
    names = columns.names
    length_at = 1 + names.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                lengths = one.column(length_at).flatten().to_numpy()
                of = np.frombuffer(one.column(one.num_columns - 2)[0].as_py(), np.int32).astype(np.int64)
                order = np.argsort(of, kind="stable")
                ahead = np.cumsum(lengths[order]) - lengths[order]
                starts = np.r_[True, of[order][1:] != of[order][:-1]]
                offset = np.empty(len(of), np.int64)
                offset[order] = ahead - np.maximum.accumulate(np.where(starts, ahead, 0))
                filled = np.bincount(of, lengths).astype(np.int64)[of]
                sequence = (one.column(0)[0].as_py() * SHARD + of) * 2 + turn
                own = [one.column(1 + k).flatten().cast(arrow.field(k).type) for k in range(len(names))]
                took = np.full(len(of), one.column(one.num_columns - 1)[0].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([*own, pa.array(sequence), pa.array(offset), pa.array(took), pa.array(filled)], schema=arrow)

    return shards.join(best, "shard").select("shard", *names, "elite", "generations").mapInArrow(run, schema)


def _deal(rows: DataFrame, shard: int) -> DataFrame:
    """Even shards, whatever the rows hold: round robin into partitions of whole shards."""
    n = rows.count()
    each = shard * max(1, n // (shard * 4096))  # pieces of a partition: more than a shard for very large tables
    return cut_lineage(_shards(rows.repartition(max(1, -(-n * 10 // (each * 9)))), shard))


def pack(docs: DataFrame, vocabulary: str, keep: list[str], text_col: str = "text", capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """One row per piece: the columns in ``keep``, piece, start, length, ids_crc32, sequence_id, offset, and
    the generations that the search of the piece's shard took."""
    if shard > SHARD:
        raise ValueError(f"a shard has at most {SHARD} pieces")
    rows = cut_lineage(pieces(docs, vocabulary, keep, text_col, capacity))
    columns = rows.schema
    shards = _deal(rows, shard)
    first = cut_lineage(_placed(shards, _solve(shards, capacity), columns, capacity, 0))
    loose = F.col("filled") < int(LOOSE * capacity)
    again = _deal(first.filter(loose).select(*columns.names), shard)
    second = _placed(again, _solve(again, capacity), columns, capacity, 1)
    return first.filter(~loose).unionByName(second).drop("filled")
