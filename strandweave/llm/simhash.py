"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes. Two fingerprints at most ``d`` bits apart differ in
at most ``d`` bytes, so they share at least ``8 - d`` positional bytes (5 for d = 3). Of any
``8 - (8-d) + l`` positions they then share at least ``l``; with l = 3 every pair within 3 bits
shares three of the first six bytes. The inverted index is therefore keyed by three of the first
six (position, byte) postings at a time: 20 postings of 24 bits a fingerprint. Inside a posting
list, the positional bytes that each pair shares are tallied, pairs that reach the guaranteed
minimum go on, and the differing bits of those are counted.

Scale: equal fingerprints are one node from the start (copies never meet as pairs). Posting lists
of one fingerprint are dropped before any data is moved to Python. A long posting list is cut into
blocks of at most ``BLOCK`` fingerprints in expectation and every pair of blocks is a tile of its
own, so that no task gets an unbounded list; a tile returns a spanning forest of its links (fewer
links than nodes) instead of all pairs. A list of n different fingerprints makes about n^2 / (2 * 512)
tile rows (5,000 make 45,000); such a list needs n different texts that agree in three bytes. Components come from alternating large-star and small-star rounds,
checkpointed each round, until a round changes no link. Fingerprints and components that hold more than
one row of ``HOT_SHARE`` are joined by a broadcast of those few, so no key fills one task.

Defined cases: null or blank text has fingerprint zero and links like any other; rows with a null id
take part, a component's id is the smallest non-null doc_id in it; repeated rows come back repeated;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage, map_texts

#: Fingerprints of one posting list that meet in one tile side.
BLOCK = 512
#: Posting lists up to this long are compared by shifted rows, many lists at once.
SHORT = 12
#: A key is hot if it holds more than this part of all rows: there are fewer than 64 such keys.
HOT_SHARE = 64
HASH_SEED = 42
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)


def fingerprint(text: str | None, width: int = 3) -> int:
    """Signed 64-bit SimHash of the text's word shingles (ASCII lower case, repeats counted)."""
    w = (text or "").encode("utf-8").lower().split()
    if not w:
        return 0
    if len(w) <= width:
        shingles = [b" ".join(w)]
    else:
        shingles = map(b" ".join, zip(*(w[i:] for i in range(width)), strict=False))
    h = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=HASH_SEED), shingles), np.uint64)
    return majority_bits(h)


def majority_bits(h: np.ndarray) -> int:
    """A bit is 1 if set in more than half of the hashes."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(h), 4096):
        part = h[at : at + 4096].astype("<u8", copy=False)
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits((total * 2 > len(h)).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """One row per document: ``id_col`` and ``fp`` (long)."""

    def make():
        return lambda texts: [[fingerprint(t, width) for t in texts]]

    return map_texts(docs, make, [id_col], text_col, T.StructType([T.StructField("fp", T.LongType())]))


def _postings(fp: Column, max_bits: int) -> Column:
    """Composite postings of a fingerprint: list number and bytes, packed in a long."""
    level = max(1, 8 - max_bits - 2)
    span = max_bits + level
    byte = [F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255)) for p in range(span)]
    keys = []
    for number, chosen in enumerate(combinations(range(span), level)):
        packed = F.lit(number).cast("long")
        for p in chosen:
            packed = F.shiftleft(packed, 8).bitwiseOR(byte[p])
        keys.append(packed)
    return F.array(*keys)


def linked(a: np.ndarray, b: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filter, then verification, of pairs of unsigned fingerprints (broadcasting)."""
    x = a ^ b
    shared = np.bitwise_count(~(((x & _LOW7) + _LOW7) | x | _LOW7))
    return (shared >= 8 - max_bits) & (np.bitwise_count(x) <= max_bits)


def tile_forest(u: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (smallest member, member) of the graph among distinct fingerprints."""
    heads, members = [], []
    rest = np.sort(u)
    while len(rest) > 1:
        head, rest = rest[:1], rest[1:]
        front = head
        while len(front) and len(rest):
            hit = np.zeros(len(rest), bool)
            for at in range(0, len(front), 64):
                hit |= linked(front[at : at + 64, None], rest[None, :], max_bits).any(axis=0)
            front, rest = rest[hit], rest[~hit]
            members.append(front)
            heads.append(np.repeat(head, len(front)))
    if not members:
        return u[:0], u[:0]
    return np.concatenate(heads), np.concatenate(members)


def _tile_links(max_bits: int):
    """Links of the tiles in a partition that is sorted by tile."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(tile: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.flatnonzero(np.r_[True, (tile[1:] != tile[:-1]).any(axis=1)])
        sizes = np.diff(np.r_[starts, len(tile)])
        a, b = [], []
        short = np.repeat(sizes <= SHORT, sizes)
        number = np.repeat(np.arange(len(sizes)), sizes)[short]
        few = fp[short]
        for d in range(1, int(sizes[sizes <= SHORT].max(initial=1))):
            at = np.flatnonzero(number[d:] == number[:-d])
            at = at[linked(few[at], few[at + d], max_bits)]
            a.append(few[at])
            b.append(few[at + d])
        for start, size in zip(starts[sizes > SHORT], sizes[sizes > SHORT], strict=True):
            x, y = tile_forest(np.unique(fp[start : start + size]), max_bits)
            a.append(x)
            b.append(y)
        return (np.concatenate(a), np.concatenate(b)) if a else (fp[:0], fp[:0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def table(parts):
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

        for batch in batches:
            if not batch.num_rows:
                continue
            tile = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(2)])
            fp = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
            held.append((tile, fp))
            tile, fp = table(held)
            # The last tile may go on in the next batch.
            cut = int(np.flatnonzero(np.r_[True, (tile[1:] != tile[:-1]).any(axis=1)])[-1])
            held = [(tile[cut:], fp[cut:])]
            if cut:
                a, b = links(tile[:cut], fp[:cut])
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)
        if held:
            a, b = links(*table(held))
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], schema=schema)

    return run


def links_of(nodes: DataFrame, max_bits: int = 3, block: int = BLOCK) -> DataFrame:
    """Links ``(a, b)`` among distinct fingerprints (column ``fp``) that connect every pair within
    ``max_bits`` bits, as a spanning forest of each tile."""
    post = nodes.select("fp", F.explode(_postings(F.col("fp"), max_bits)).alias("post"))
    lists = post.groupBy("post").agg(F.count("*").alias("n")).filter("n > 1")
    # The number of lists with two fingerprints or more has no bound: no broadcast hint.
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    sides = F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: o != F.col("own")),
            lambda o: F.least(o, F.col("own")).cast("long") * F.col("blocks") + F.greatest(o, F.col("own")),
        )
    )
    tiles = (
        post.join(lists, "post")
        .withColumn("blocks", blocks)
        .withColumn("own", own)
        .select("post", F.explode(sides).alias("tile"), "fp")
    )
    spread = tiles.repartition("post", "tile").sortWithinPartitions("post", "tile")
    return spread.mapInArrow(_tile_links(max_bits), "a long, b long")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of a link table: ``node``, ``root`` (the smallest node reachable).

    Alternating large-star and small-star; each round is two grouped minima and two joins, and
    halves the depth at least, so that even long chains end after a number of rounds that is
    logarithmic in their length. It ends when a round leaves all links as they were.
    """
    edges = cut_lineage(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    )
    n = edges.count()
    while n:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.*")
            .filter("u <> v")
            .distinct()
        )
        before, n_before = edges, n
        edges = cut_lineage(small)
        n = edges.count()
        # Both are sets of links: of equal size and without a new one, they are the same.
        if n == n_before and edges.join(before, ["u", "v"], "left_anti").isEmpty():
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def join_counted(rows: DataFrame, keyed: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``keyed`` (unique in ``key``; ``n``: how many of the ``total`` rows have
    it). The few hot keys are broadcast, the others joined by a shuffle."""
    is_hot = F.col("n") * HOT_SHARE > total
    hot, others = F.broadcast(keyed.filter(is_hot).drop("n")), keyed.filter(~is_hot).drop("n")
    rest = rows.join(hot.select(key), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(others, key))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_bits: int = 3,
    width: int = 3,
) -> DataFrame:
    """One row per document: ``id_col``, ``fp`` (long), ``component_id``."""
    fps = cut_lineage(fingerprints(docs, id_col, text_col, width))
    nodes = cut_lineage(fps.groupBy("fp").agg(F.min(id_col).alias("first_id"), F.count("*").alias("n")))
    parts = components(links_of(nodes.select("fp"), max_bits))
    # A node without links is not in parts: it is its own root.
    rooted = nodes.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.col("n").alias("rows"), F.coalesce("root", "fp").alias("root")
    )
    rooted = cut_lineage(rooted)
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"), F.count("*").alias("n"), F.sum("rows").alias("in_all"))
    ids = cut_lineage(ids)
    n_nodes, n_rows = ids.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("in_all"), F.lit(0))).first()
    named = join_counted(rooted, ids.drop("in_all"), "root", n_nodes).select("fp", "component_id", F.col("rows").alias("n"))
    return join_counted(fps, cut_lineage(named), "fp", n_rows).select(id_col, "fp", "component_id")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
