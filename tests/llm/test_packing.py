import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from strandweave.llm import packing, queries

from .data import TEXTS, edge_docs, no_docs

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def check_sequences(rows, capacity=4096):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for items in bins.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def library_ids(text):
    return np.array(Tokenizer.from_file(VOCABULARY).encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def test_query_round_trip(spark, small):
    rows = queries.op2_best_fit_packing(spark, small).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    tokenizer = Tokenizer.from_file(VOCABULARY)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert by.keys() == docs.keys()
    for i, text in docs.items():
        ids, at = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4"), 0
        for k, r in enumerate(sorted(by[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and r.length == min(4096, len(ids) - at)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    total = sum(r.length for r in rows)
    assert check_sequences(rows) <= -(-total // 4096) + 1


def test_odd_rows(spark):
    rows = packing.pack(edge_docs(spark), VOCABULARY, ["doc_id"], shard=5).collect()
    check_sequences(rows)
    want = sorted((str(i), zlib.crc32(ids[at : at + 4096].tobytes())) for i, t, _, _ in TEXTS for ids in [library_ids(t)] for at in range(0, len(ids), 4096))
    assert sorted((str(r.doc_id), r.ids_crc32) for r in rows) == want
    assert packing.pack(no_docs(spark), VOCABULARY, ["doc_id"]).count() == 0


def test_capacity_borders():
    p = packing.Packing([4096, 4096, 1, 4095, 2048, 2048], 4096)
    p.best_fit(range(6))
    assert len(p.bins) == 4 and set(p.free.values()) == {0}


def best_fit_decreasing(lengths):
    plain = packing.Packing(lengths.tolist(), 4096)
    plain.best_fit(np.argsort(-lengths, kind="stable").tolist())
    return plain


def test_genetic_steps_keep_every_piece_and_never_lose_to_best_fit():
    rng = np.random.default_rng(1)
    for seed in range(5):
        lengths = rng.integers(900, 2600, 120)
        plain = best_fit_decreasing(lengths)
        best, _ = packing.evolve(lengths, [], [seed], 4096, 10)
        again, _ = packing.evolve(lengths, [best.codes()], [seed, 1], 4096, 10)
        for p in (best, again, packing.crossover(plain, best, rng), packing.mutate(best, rng)):
            assert sorted(i for g in p.groups() for i in g) == list(range(120))
            assert all(lengths[g].sum() == 4096 - p.free[b] <= 4096 for b, g in p.bins.items())
            assert p.order == sorted((f, b) for b, f in p.free.items())
        assert plain.fitness() <= best.fitness() <= again.fitness()


def test_generations_gain_where_best_fit_is_above_the_bound():
    rng = np.random.default_rng(2)
    for low, high, gain in ((900, 2600, 4), (1200, 1900, 25), (1000, 4000, 0)):
        lengths = rng.integers(low, high, 2048)
        plain, least = best_fit_decreasing(lengths), packing.least_bins(lengths, 4096)
        best, taken = packing.evolve(lengths, [], [1], 4096, packing.GENERATIONS)
        assert least <= len(best.bins) <= len(plain.bins) - gain
        # A stop before the last generation is a proof.
        assert taken == packing.GENERATIONS or len(best.bins) == least


def fewest_bins(lengths, capacity):
    """Tries every place of every piece."""
    best = len(lengths)

    def place(k, free):
        nonlocal best
        if len(free) >= best:
            return
        if k == len(lengths):
            best = len(free)
            return
        for b in {f: i for i, f in enumerate(free) if f >= lengths[k]}.values():
            place(k + 1, [f - lengths[k] * (i == b) for i, f in enumerate(free)])
        place(k + 1, [*free, capacity - lengths[k]])

    place(0, [])
    return best


def test_no_packing_goes_below_the_least():
    rng = np.random.default_rng(3)
    tight = 0
    for _ in range(150):
        lengths = rng.integers(1, 21, rng.integers(1, 9))
        least, fewest = packing.least_bins(lengths, 20), fewest_bins(lengths.tolist(), 20)
        assert -(-int(lengths.sum()) // 20) <= least <= fewest
        tight += least == fewest
    assert tight > 120 and packing.least_bins(np.array([], int), 20) == 0
