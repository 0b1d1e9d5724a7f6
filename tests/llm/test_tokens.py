import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strandweave.llm import queries, tokencount, tokens

from .data import TEXTS, edge_docs, no_docs

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
BITS = [
    "don't", "WE'LL", "'s", "'S", "it''s", "  ", "\n\n", "\t", "\r\n", " \n x", "3.14", "١٢", "½", "<|endoftext|>", "<|startoftext|>", "<|end", "é", "é",
    "İ", "ß", "ﬁ", " ", "\u0085", "​", "\x1f", "\x00", "你好", "😀", "...!!", "foo_bar", "https://a.b/c?d=e", "naïve", "ÀÉ", "of", " the", "THE", " ", "ſ", "K", "ı", "ɏ", "Ǆ",
]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    return ["".join(rng.choices(BITS, k=rng.randint(0, 20))) for _ in range(1500)] + [t or "" for _, t, _, _ in TEXTS]


def test_byte_counts_equal_the_library(texts):
    count, library = tokens.ByteCounts(BYTE, tokens.prove(BYTE)), Tokenizer.from_file(BYTE)
    assert count.known and len(count.single) > 40_000
    assert [count(t) for t in texts] == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_word_ids_equal_the_library(texts, monkeypatch):
    library = Tokenizer.from_file(WORD)
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    ids = tokens.WordIds(WORD)
    assert ids.known and [ids(t) for t in texts] == want
    monkeypatch.setattr(tokens, "TABLE_LIMIT", 10)  # tables are emptied all the time
    ids = tokens.WordIds(WORD)
    assert [ids(t) for t in texts] == want


def random_words(rng, n):
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "aeiost", "ABCDxyz", "éèüßñça", "0123456789", "!?.,#-=_", "a"]
    return ["".join(rng.choices(rng.choice(alphabets), k=rng.randint(1, 40))) for _ in range(n)]


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_merges_equal_the_library(path):
    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    library = Tokenizer.from_file(path)
    pattern = tokens.regex.compile(tokens.WORD_PATTERN if path == WORD else tokens.BYTE_PATTERN)
    words = random_words(random.Random(6), 4000)
    words += [w for t in config["model"]["vocab"] if (w := t.replace("</w>", "").replace("Ġ", " ")) and w.isascii()][:8000]
    words = [w for w in dict.fromkeys(w.lower() if path == WORD else w for w in words) if pattern.findall(w) == [w]]
    got = {}
    words = [w for w in words if len(w.encode()) <= tokens.LONG]
    for numbers, ids, sizes in tokens.PairMerges(config)([w.encode() for w in words]):
        got.update((words[i], row[:n]) for i, row, n in zip(numbers, ids.tolist(), sizes, strict=True))
    assert len(words) > 5000 and got == {w: e.ids for w, e in zip(words, library.encode_batch(words, add_special_tokens=False), strict=True)}


def test_mixed_scripts_send_little_to_the_library(monkeypatch):
    rng = random.Random(8)
    library = Tokenizer.from_file(BYTE)
    count = tokens.ByteCounts(BYTE, tokens.prove(BYTE))
    sent = []
    monkeypatch.setattr(count, "_library", lambda t: sent.append(t) or len(library.encode(t, add_special_tokens=False).ids))
    odd = ["“quoted”", "a—b", "你好", "naïve…", "😀", "\u200bx", "x\u0301", "\u2003", "\x85", "’s"]
    bits = ["plain", "words", " ", "  ", "\n", "don't", "3.5", ","]
    for _ in range(600):
        text = " ".join(rng.choices(bits, k=rng.randint(0, 30)) + rng.choices(odd, k=rng.randint(0, 3)))
        text = " ".join(rng.sample(text.split(" "), text.count(" ") + 1)) + rng.choice(["", " ", "\n", "”"])
        assert count(text) == len(library.encode(text, add_special_tokens=False).ids), text
    sent.clear()
    text = "many plain words stand here in one row " * 500 + "“one quote” " + "and many more of them stand behind it " * 500
    assert count(text) == len(library.encode(text, add_special_tokens=False).ids)
    assert sum(map(len, sent)) < 40


def test_query(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    library = Tokenizer.from_file(BYTE)
    for r in queries.op7_token_counts(spark, small).collect():
        n = len(library.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(docs[r.doc_id].encode()), n > 512)


def test_odd_rows(spark):
    got = tokencount.count_tokens(edge_docs(spark), BYTE, ["doc_id"]).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 16 and (by[1].n_bytes, by[1].n_tokens, by[1].over_limit) == (0, 0, False) and by[6].over_limit
    assert tokencount.count_tokens(no_docs(spark), BYTE, ["doc_id"]).count() == 0
