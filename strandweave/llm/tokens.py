"""Exact token ids and counts of public tokenizers, with the library called for odd strings only.

:class:`WordIds` gives the ids of a lower-casing word-end BPE. White space always ends a pre-token
there, so that the ids of a text are those of its white-space separated strings, one after the
other. Strings seen before come from a table; new ones are split into pre-tokens, and pre-tokens not
seen before are merged, many at once, by :class:`PairMerges`.

:class:`ByteCounts` counts the tokens of a byte-level BPE by the whole-token shortcut. It is proved once,
by encoding every vocabulary string alone with the library, which of them come back as one token; the
proven set is what the workers get. A pre-token that is one of them counts one without any merge. Only
other pre-tokens are merged, and remembered.

Both tables are bounded: a full one is emptied. Characters about which the library and the patterns
here might differ (control characters, and all beyond the Latin blocks, for which Unicode versions
differ) go to the library, each with no more of the text around it than white space parts off.
"""

from __future__ import annotations

import json
import os

import numpy as np
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from tokenizers import Tokenizer  # noqa: E402

#: Strings that a table of a worker holds at most.
TABLE_LIMIT = 300_000

#: White space, printable ASCII and the Latin blocks, but for the dotted capital I, whose lower case has two code points.
_PLAIN = regex.compile(r"[\t\n\r\x20-\x7e\xa0-įı-ɏ]*")

# The pre-token patterns of the two vocabularies.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: White space of plain texts, and a run of odd characters.
_BREAK = regex.compile(r"[\t\n\r\x20\xa0]+")
_ODD = regex.compile(r"[^\t\n\r\x20-\x7e\xa0-įı-ɏ]+")
#: Pre-tokens longer than this many bytes are merged by the library.
LONG = 64
#: Characters whose new pre-tokens are merged at once.
STRETCH = 1 << 18

_CACHE: dict[tuple[str, str], object] = {}


def word_ids(path: str) -> WordIds:
    """One a worker process and vocabulary."""
    if ("word", path) not in _CACHE:
        _CACHE["word", path] = WordIds(path)
    return _CACHE["word", path]


def byte_counts(path: str, proven: frozenset[str]) -> ByteCounts:
    """One a worker process and vocabulary."""
    if ("byte", path) not in _CACHE:
        _CACHE["byte", path] = ByteCounts(path, proven)
    return _CACHE["byte", path]


def _specials(config: dict) -> list[str]:
    return [t["content"] for t in config["added_tokens"]]


def stretches(texts: list[str]):
    """The texts in order, as lists of a bounded number of characters (or of one text)."""
    some: list[str] = []
    size = 0
    for t in texts:
        if some and size + len(t) > STRETCH:
            yield some
            some, size = [], 0
        some.append(t)
        size += len(t)
    if some:
        yield some


def _is_plain_bpe(model: dict) -> bool:
    return model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"))


def byte_characters() -> list[str]:
    """The printable stand-ins of the byte-level alphabet: visible bytes stand for themselves, the others
    are counted on from 256."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class PairMerges:
    """Byte-pair merges of many strings at once.

    Each round merges in every string the leftmost pair of the lowest rank, which is the library's order;
    strings of one length are rows of one matrix, and a string without a pair to merge is done."""

    NONE = np.int32(2**31 - 1)

    def __init__(self, config: dict):
        vocab, suffix = config["model"]["vocab"], config["model"].get("end_of_word_suffix") or ""
        characters = byte_characters()
        self.first = np.array([vocab[c] for c in characters], np.uint32)
        self.last = np.array([vocab[c + suffix] for c in characters], np.uint32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in config["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.uint64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.uint32)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.uint64) << np.uint64(32) | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], self.NONE)

    def of_matrix(self, data: np.ndarray, size: np.ndarray):
        """``data``: bytes, a row a string, padded behind its size. Yields (row numbers, ids, sizes) as
        strings are done."""
        every = np.arange(len(data))
        ids = self.first[data]
        ids[every, size - 1] = self.last[data[every, size - 1]]
        rank = self.rank(ids[:, :-1], ids[:, 1:])
        rank[np.arange(rank.shape[1]) >= size[:, None] - 1] = self.NONE
        rows = every
        while len(rows) and rank.shape[1]:
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(rows)), at]
            going = best != self.NONE
            if not going.all():
                yield rows[~going], ids[~going], size[~going]
                rows, ids, rank, size, at, best = (x[going] for x in (rows, ids, rank, size, at, best))
            every, size = np.arange(len(rows)), size - 1
            ids[every, at] = self.made[best]
            # What is behind the merged pair moves up by one.
            step = np.arange(ids.shape[1] - 1)
            ids = np.where(step > at[:, None], ids[:, 1:], ids[:, :-1])
            rank = np.where(step[:-1] >= at[:, None], rank[:, 1:], rank[:, :-1])
            # The pairs on either side of it are new.
            for k, has in ((at - 1, at > 0), (at, at < size - 1)):
                r, c = every[has], k[has]
                rank[r, c] = self.rank(ids[r, c], ids[r, c + 1])
        if len(rows):
            yield rows, ids, size

    def __call__(self, strings: list[bytes]):
        """Yields (number of a string, its ids, their count) until all are done; the ids may be padded."""
        size = np.array([len(s) for s in strings])
        least = 0
        for most in (4, 8, 12, 16, 24, 32, 48, LONG):
            of = np.flatnonzero((size > least) & (size <= most))
            least = most
            for cut in range(0, len(of), 1 << 14):
                part = of[cut : cut + (1 << 14)]
                if not len(part):
                    continue
                width = int(size[part].max())
                data = np.frombuffer(b"".join([strings[i].ljust(width, b"\0") for i in part.tolist()]), np.uint8).reshape(-1, width)
                for rows, ids, left in self.of_matrix(data, size[part]):
                    yield part[rows].tolist(), ids, left.tolist()


class WordIds:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = _specials(config)
        steps = (config.get("normalizer") or {}).get("normalizers", [])
        split = ((config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.known = [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"] and split.get("pattern", {}).get("Regex") == WORD_PATTERN and _is_plain_bpe(config["model"])
        self.find = regex.compile(WORD_PATTERN).findall
        self.merges = PairMerges(config) if self.known else None
        self.strings: dict[str, bytes] = {}
        self.pre: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.library.encode_batch(texts, add_special_tokens=False)]

    def __call__(self, text: str) -> bytes:
        return self.many([text])[0]

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        return [ids for some in stretches(texts) for ids in self._some(some)]

    def _some(self, texts: list[str]) -> list[bytes]:
        whole = [not self.known or any(s in t for s in self.specials) for t in texts]
        plain = [not w and _PLAIN.fullmatch(t) is not None for t, w in zip(texts, whole, strict=True)]
        # Odd characters keep their case here: the library lowers them.
        strings = [t.lower().split() if p else [] if w else _BREAK.split(t) for t, p, w in zip(texts, plain, whole, strict=True)]
        if new := set().union(*(x for x, p in zip(strings, plain, strict=True) if p)).difference(self.strings):
            self._learn(new)
        if new := set().union(*(x for x, p in zip(strings, plain, strict=True) if not p)).difference(self.strings):
            odd = [s for s in new if not _PLAIN.fullmatch(s)]
            self.strings.update(zip(odd, self._library(odd), strict=True))
            low = {s: s.lower() for s in new.difference(odd)}
            self._learn(set(low.values()).difference(self.strings))
            self.strings.update((s, self.strings[x]) for s, x in low.items())
        out = [self._library([t])[0] if w else b"".join(map(self.strings.__getitem__, x)) for t, w, x in zip(texts, whole, strings, strict=True)]
        if len(self.strings) > TABLE_LIMIT:
            self.strings.clear()
        if len(self.pre) > TABLE_LIMIT:
            self.pre.clear()
        return out

    def _learn(self, new: set[str]) -> None:
        """Plain strings in lower case."""
        # A string of letters alone is one pre-token.
        whole = [s for s in new if s.isalpha()]
        parts = {s: self.find(s) for s in new.difference(whole)}
        unknown = {p for v in parts.values() for p in v}.union(whole).difference(self.pre)
        if unknown:
            self._merge(list(unknown))
        pre = self.pre
        self.strings.update((s, pre[s]) for s in whole)
        self.strings.update((s, b"".join([pre[p] for p in v])) for s, v in parts.items())

    def _merge(self, unknown: list[str]) -> None:
        coded = [p.encode("utf-8") for p in unknown]
        long = [p for p, c in zip(unknown, coded, strict=True) if len(c) > LONG]
        if long:
            self.pre.update(zip(long, self._library(long), strict=True))
            unknown, coded = [p for p, c in zip(unknown, coded, strict=True) if len(c) <= LONG], [c for c in coded if len(c) <= LONG]
        for numbers, ids, sizes in self.merges(coded):
            data, width = ids.astype("<u4").tobytes(), 4 * ids.shape[1]
            for k, (i, n) in enumerate(zip(numbers, sizes, strict=True)):
                self.pre[unknown[i]] = data[k * width : k * width + 4 * n]


class ByteCounts:
    def __init__(self, path: str, proven: frozenset[str]):
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.specials = _specials(config)
        self.known = is_byte_level(config)
        self.find = regex.compile(BYTE_PATTERN).findall
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")
        self.merges = PairMerges(config) if self.known else None
        self.single = dict.fromkeys(proven, 1)
        self.counts = dict(self.single)

    def _library(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def __call__(self, text: str) -> int:
        return self.many([text])[0]

    def many(self, texts: list[str]) -> list[int]:
        return [n for some in stretches(texts) for n in self._some(some)]

    def _some(self, texts: list[str]) -> list[int]:
        parted = [self._parts(t) for t in texts]
        if new := set().union(*(tokens for _, lists in parted for tokens in lists)).difference(self.counts):
            self._learn(new)
        out = [n + sum(sum(map(self.counts.__getitem__, tokens)) for tokens in lists) for n, lists in parted]
        if len(self.counts) > TABLE_LIMIT:
            self.counts = dict(self.single)
        return out

    def _parts(self, text: str) -> tuple[int, list[list[str]]]:
        """Tokens that are counted already, and the pre-tokens of the plain stretches."""
        if not self.known:
            return self._library(text), []
        parts = self.cut.split(text) if any(s in text for s in self.specials) else [text]
        done, lists = len(parts) - 1, []
        for part in parts:
            at = 0
            for start, end in [] if _PLAIN.fullmatch(part) else odd_stretches(part):
                lists.append(self.find(part[at:start]))
                done += self._library(part[start:end])
                at = end
            lists.append(self.find(part[at:]))
        return done, lists

    def _learn(self, new: set[str]) -> None:
        coded = {t: t.encode("utf-8") for t in new}
        short = [t for t, c in coded.items() if len(c) <= LONG]
        for numbers, _, sizes in self.merges([coded[t] for t in short]):
            self.counts.update((short[i], n) for i, n in zip(numbers, sizes, strict=True))
        for t in new.difference(short):
            self.counts[t] = self._library(t)


def is_byte_level(config: dict) -> bool:
    pre = config.get("pre_tokenizer") or {}
    kept = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in config["added_tokens"])
    return config.get("normalizer") is None and pre.get("type") == "ByteLevel" and bool(pre.get("use_regex")) and not pre.get("add_prefix_space") and kept and _is_plain_bpe(config["model"])


def prove(path: str) -> frozenset[str]:
    """The vocabulary strings that are one pre-token and that the library encodes alone as one token."""
    with open(path, encoding="utf-8") as f:
        config = json.load(f)
    if not is_byte_level(config):
        return frozenset()
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    specials, find, texts = _specials(config), regex.compile(BYTE_PATTERN).findall, []
    for token in config["model"]["vocab"]:
        if token in specials or any(c not in byte_of for c in token):
            continue
        try:
            text = bytes(byte_of[c] for c in token).decode("utf-8")
        except UnicodeDecodeError:
            continue
        if _PLAIN.fullmatch(text) and find(text) == [text]:
            texts.append(text)
    coded = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    return frozenset(t for t, e in zip(texts, coded, strict=True) if len(e.ids) == 1)


def odd_stretches(text: str) -> list[tuple[int, int]]:
    """Stretches that hold all odd characters, parted from the rest where a pre-token begins for sure: at
    a single space between two plain characters that are no white space."""

    def parts(i: int) -> bool:
        sides = text[i - 1 : i] + text[i + 1 : i + 2]
        return i > 0 and len(sides) == 2 and not _BREAK.search(sides) and not _ODD.search(sides)

    found: list[tuple[int, int]] = []
    for run in _ODD.finditer(text):
        least = found[-1][1] if found else 0
        if run.start() < least:
            continue
        start = text.rfind(" ", least, run.start())
        while start > least and not parts(start):
            start = text.rfind(" ", least, start)
        # The end of the stretch before is such a place as well.
        start = max(start, least)
        end = text.find(" ", run.end())
        while end >= 0 and not parts(end):
            end = text.find(" ", end + 1)
        found.append((start, len(text) if end < 0 else end))
    return found
