import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from strandweave.llm import queries, simhash

from .data import edge_docs, no_docs


def brute_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, max_bits=3):
    """fps: unsigned by node; the smallest node reachable of each."""
    nodes, root = sorted(fps), {}
    for n in nodes:
        if n in root:
            continue
        todo, root[n] = [n], n
        while todo:
            x = todo.pop()
            for y in nodes:
                if y not in root and (fps[x] ^ fps[y]).bit_count() <= max_bits:
                    root[y] = n
                    todo.append(y)
    return root


def test_query_against_brute_force(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    fps = {i: brute_fingerprint(t) for i, t in docs.items()}
    got = {r.doc_id: r for r in queries.op6_simhash_near_dedup(spark, small).collect()}
    assert {i: r.fingerprint for i, r in got.items()} == {i: format(f, "016x") for i, f in fps.items()}
    assert {i: r.component_id for i, r in got.items()} == brute_components(fps)


def test_odd_rows(spark):
    got = simhash.near_duplicates(edge_docs(spark)).collect()
    assert len(got) == 16
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert {by[i][0].fp for i in (1, 2, 3)} == {0} and {by[i][0].component_id for i in (1, 2, 3)} == {1}
    assert [r.component_id for r in by[8]] == [8, 8] and by[7][0].component_id == 6
    assert sorted((r.fp == 0, r.component_id) for r in by[None]) == [(False, None), (True, 1)]
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


def test_links_within_three_bits_with_long_lists(spark):
    rng = random.Random(5)
    hubs = [rng.getrandbits(64) for _ in range(6)]
    fps = set(hubs)
    for hub in hubs:
        x = hub
        for _ in range(60):  # chains and balls round each hub
            x ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 5)))
            fps.add(x)
            fps.add(hub ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    fps |= {0, 1, 7, (1 << 64) - 1}
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = brute_components({f: f % (1 << 64) for f in signed})
    for block in (8, 512):  # many tiles a list, or one
        links = simhash.links_of(nodes, block=block)
        assert links.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > 64).count() == 0
        found = {r.node: r.root for r in simhash.components(links).collect()}
        assert {f: found.get(f, f) for f in signed} == want


def test_components_of_a_long_chain(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.root for r in simhash.components(links).collect()} == {0}
