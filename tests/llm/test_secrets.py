import hashlib
import random
import re
import string
import time

import pandas as pd
import public_tokenizers
import pytest
import zstandard
from pyspark.ml import feature
from pyspark.sql import functions

from strandweave.llm import primer, queries, secrets

from .data import edge_docs, no_docs


VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def novelty():
    return secrets.Novelty(primer.dictionary(VOCABULARY))


def brute_base(text):
    low = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    word = "|".join([*map(low, ("password", "passwd", "secret", "token")), low("api") + "_?" + low("key")])
    found = [("assign", m) for m in re.finditer(rf"""({word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 6]
    found += [("access", m) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    order = ["assign", "access", "hex"]
    found.sort(key=lambda x: (x[1].start(), order.index(x[0])))
    return [f"{k}:{m.start()}:{m.end()}" for k, m in found]


def test_query_against_brute_force(spark, small):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    got = queries.op4_secret_scan(spark, small).collect()
    assert len(got) == len(docs)
    for r in got:
        base = brute_base(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(x.startswith(k) for x in base) for k in ("assign", "access", "hex"))
        assert set(base) <= set(r.spans.split(",")) | {""}


def test_random_texts_against_brute_force(novelty):
    rng = random.Random(3)
    bits = ["password", "Token", "API_KEY", "apikey", '"', "'", " ", ":", "=", "AKIA", "ABCDEFGHIJKLMNOPQ", "0123456789ab", "abcdef", "é", "\n", "x.y-z/", "ſecret", "toKen"]
    for _ in range(3000):
        text = "".join(rng.choices(bits, k=rng.randint(0, 14)))
        base = [x for x in secrets.scan_text(text, novelty)[5].split(",") if x and not x.startswith("novel")]
        assert base == brute_base(text), text


def brute_novel(text, base):
    """Novel places by their definition, character by character."""
    words = ["passphrase", "password", "passwd", "pwd", "secret", "token", "credentials", "credential", "authorization", "bearer"]
    words += [a + j + b for a, b in [*((x, "key") for x in ("api", "access", "private", "signing", "encryption")), ("client", "id"), ("connection", "string")] for j in ("", "_", "-", " ")]
    low = "".join(c.lower() if c.isascii() else c for c in text)
    ends = {i + len(w) for w in words for i in range(len(low)) if low.startswith(w, i)}
    allowed = set(string.ascii_letters + string.digits + "+/_=-")
    taken = [tuple(map(int, x.split(":")[1:])) for x in base]
    compressor = zstandard.ZstdCompressor(level=12, dict_data=zstandard.ZstdCompressionDict(primer.dictionary(VOCABULARY), dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_checksum=False, write_content_size=False)
    runs, at = [], 0
    while at < len(text):
        end = at
        while end < len(text) and text[end] in allowed:
            end += 1
        if end - at >= 16:
            runs.append((at, end))
        at = max(end, at + 1)
    near = []
    for s, e in runs:
        if not any(s - 48 <= x <= s for x in ends):
            inside = [x for x in ends if s < x <= e]
            if not inside:
                continue
            s = min(inside)
            while s < e and text[s] in "=_-/+":
                s += 1
        if e - s >= 16 and not any(a < e and s < b for a, b in taken):
            near.append((s, e))
    novel = set()
    for s, e in near:
        word = text[s:e]
        n = len(word)
        left, right = (x.replace(word, "") for x in (text[max(0, s - 256 - n) : s], text[e : e + 256 + n]))
        left, right = left[n:] if s - 256 - n > 0 else left, right[: max(0, len(right) - n)] if e + 256 + n < len(text) else right
        before, after = left[-256:], right[:256]
        size = [len(compressor.compress(x.encode())) for x in (before + word + after, before + after)]
        if size[0] - size[1] >= 0.78 * len(word):
            novel.add(word)
    every = {x for x in near if text[x[0] : x[1]] in novel}
    every |= {(s, e) for s, e in runs if text[s:e] in novel and not any(a < e and s < b for a, b in taken)}
    return [f"novel:{s}:{e}" for s, e in sorted(every)]


def test_novel_places_against_brute_force(novelty):
    rng = random.Random(17)
    key = lambda: "".join(rng.choices(string.ascii_letters + string.digits, k=rng.randint(14, 40)))
    found = 0
    for _ in range(400):
        own = [key() for _ in range(3)]
        bits = [*own, *own, "bearer", "Client ID", "the api key of", "token", "authorization_header_value", " ", " ", "=", "_", ", ", "plain words here and there ", "AKIA", "0123456789abcdef01234567", "password: ", "x" * 60]
        text = "".join(rng.choices(bits, k=rng.randint(2, 16)))
        spans = secrets.scan_text(text, novelty)[5].split(",")
        base = [x for x in spans if x and not x.startswith("novel")]
        got = [x for x in spans if x.startswith("novel")]
        assert got == brute_novel(text, base), text
        found += len(got)
    assert found > 80


def test_novel_strings_near_sensitive_words(novelty):
    rng = random.Random(9)
    secret = "".join(rng.choices(string.ascii_letters + string.digits, k=40))
    hit = f"the client credential is {secret} for now"
    start = hit.index(secret)
    assert f"novel:{start}:{start + 40}" in secrets.scan_text(hit, novelty)[5]
    # Names, and random strings without a sensitive word, are left alone.
    for clean in ("bearer authorization_header_content_type_v2", f"see {secret} there", "the api key of documentation_page_index_42 is here"):
        assert secrets.scan_text(clean, novelty)[3] == 0, clean


def test_every_copy_of_a_novel_string_is_reported(novelty):
    rng = random.Random(10)
    secret = "".join(rng.choices(string.ascii_letters + string.digits, k=40))
    text = f"{secret} then bearer {secret} again, {'and so on, ' * 90}{secret}"
    got = secrets.scan_text(text, novelty, mask=True)
    assert got[3] == 3 and secret not in got[6]


def test_time_is_linear_in_the_text(novelty):
    rng = random.Random(12)
    secret = "".join(rng.choices(string.ascii_letters + string.digits, k=32))
    long = ["token " * 800_000, "token" * 1_000_000, f"api key {secret}, " * 100_000, 'password="x1234567" ' * 250_000 + f" bearer {secret}"]
    for text, n in zip(long, (0, 0, 100_000, 1), strict=True):
        began = time.process_time()
        assert secrets.scan_text(text, novelty)[3] == n
        assert time.process_time() - began < 10


def test_mask():
    assert secrets.masked("abcdefgh", [(1, 0, 3), (2, 2, 4), (6, 0, 7)]) == "a[secret]ef[secret]h"
    assert secrets.masked("abc", []) == "abc"


def test_odd_rows(spark):
    got = secrets.scan(edge_docs(spark), ["doc_id"], mask=True).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 16 and by[1].spans == "" and by[1].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert (by[12].n_assign, by[12].n_access, by[12].n_hex) == (1, 1, 1)
    assert by[12].masked_text == '[secret]" and [secret] and [secret]'
    assert secrets.scan(no_docs(spark), ["doc_id"]).count() == 0


def test_recall_and_false_alarms(novelty):
    rng = random.Random(11)
    reported = lambda lead, word: secrets.scan_text(f"{lead} {word} for now", novelty)[3] == 1
    # 24 digits and more are of kind hex.
    for alphabet, n in ((string.ascii_letters, 20), (string.ascii_letters, 40), (string.ascii_lowercase, 20), (string.ascii_uppercase, 32), (string.digits, 20), (string.ascii_letters + string.digits, 20)):
        keys = ["".join(rng.choices(alphabet, k=n)) for _ in range(100)]
        for lead in ("bearer", "the client_id", "the credential is", "connection_string is"):
            assert sum(reported(lead, k) for k in keys) >= 98, (alphabet, n, lead)
    words = ["internationalization", "Datenschutzgrundverordnung", "professionnellement", "AuthenticationManagerBuilder", "load_balancer_health_check", "responsabilidades", "Geschwindigkeitsbegrenzung", "characteristically", "telecommunications", "extraordinariamente"]
    assert sum(reported("the api key of", w) for w in words) <= 1
    # Public names of libraries that the dictionary has not seen.
    names = sorted({k for c in (pd.DataFrame, pd, functions, feature) for k in dir(c) if re.fullmatch("[A-Za-z][A-Za-z0-9_]{15,}", k)})
    assert len(names) > 40 and sum(reported("the api key of", w) for w in names) <= len(names) // 10


def test_dictionary(tmp_path):
    (tmp_path / "a.py").write_text("def loadTable(): open_file, LOUD_NAME = 1, 2\n")
    (tmp_path / "b.py").write_text("loadTable = 3\n")
    assert primer.identifier_parts(str(tmp_path)) == ["Table", "load", "LOUD", "NAME", "file", "open"]
    words = primer.vocabulary_words(VOCABULARY)
    assert len(words) > 10_000 and all(w.isalpha() and 5 <= len(w) <= 20 for w in words)
    assert primer.dictionary(VOCABULARY) is primer.dictionary(VOCABULARY) and len(primer.dictionary(VOCABULARY)) < 1 << 20
