"""Secret scans: three fixed patterns, and novelty under a primed zstandard compressor.

Fixed kinds (leftmost non-overlapping matches of each pattern; failing ones are dropped):
``assign`` (a credential word, a colon or equals sign and a value of 6 or more characters),
``access`` (AKIA ids of 20 or more characters), ``hex`` (24 or more hexadecimal digits).

Kind ``novel``: strings near a sensitive word (token, bearer, credential, ...) that do not compress.
The compressor is primed with a dictionary of words and identifier parts (see :mod:`.primer`). A
candidate's marginal size is the compressed size of the surrounding code with the candidate in its
place, less that without it. Names, paths and words that occur nearby or in the dictionary cost a few
bytes; random strings cost close to their length, be they of letters, of digits or of both. Every
candidate is measured, and reported if its marginal bytes reach ``NOVELTY`` of its length. Other copies
of it are taken out of its surroundings first, and where one copy is reported all of the text are. Names
made of parts that are neither nearby nor in the dictionary are reported too.

A candidate is a run of 16 or more key characters that begins within ``reach`` characters of the end of
a sensitive word, or what such a run holds behind a sensitive word in it.

Scale: one pass without a shuffle, linear in the text. Only candidates are compressed, each with at most
``context`` characters on either side. The dictionary (about 250 kB, the same for any corpus) is
broadcast. Whole texts are scanned.

Defined cases: null text is the empty text: no spans, the digest of the empty string; very long texts
and runs are scanned whole; spans count code points, end exclusive, and are sorted by start, then kind
in the order assign, access, hex, novel; a novel span that overlaps a fixed one is not reported twice;
repeated rows come back repeated; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import primer
from .common import map_texts

# The patterns of the base kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
#: A run of 24 or more hexadecimal digits is a maximal run as well; short runs are skipped in the search.
HEX_LONG = re.compile(r"[0-9a-f]{24,}")
#: Lower-case strings of which a text needs one before the slower pattern is worth running.
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "api_key", "apikey")
SENSITIVE_HINTS = (
    "pass", "pwd", "secret", "token", "key", "client", "credential", "authorization", "bearer", "connection",
)
KINDS = ("assign", "access", "hex", "novel")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

#: Words that make what follows them sensitive, and the length of the longest.
SENSITIVE = re.compile(
    r"passphrase|password|passwd|pwd|secret|token|(?:api|access|private|signing|encryption)[_\x20-]?key"
    r"|client[_\x20-]?id|credentials?|authorization|bearer|connection[_\x20-]?string",
    re.I | re.A,
)
LONGEST_WORD = 17
LEAST_RUN = 16
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: What may stand between a sensitive word and a key in one run.
JOINTS = "=_-/+"
#: Characters after a sensitive word in which a candidate must begin, and of the surroundings on a side.
REACH, CONTEXT = 48, 256
#: Least share of marginal compressed bytes to characters.
NOVELTY = 0.78
LEVEL = 12
MASK = "[secret]"


class Novelty:
    """Marginal compressed size under a dictionary of words and identifier parts."""

    def __init__(self, dictionary: bytes, reach: int = REACH, context: int = CONTEXT):
        self.reach, self.context = reach, context
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._compressor = zstandard.ZstdCompressor(
            level=LEVEL, dict_data=primed, write_checksum=False, write_content_size=False
        )

    def marginal(self, before: str, candidate: str, after: str) -> int:
        size = lambda s: len(self._compressor.compress(s.encode("utf-8", "surrogatepass")))
        return size(before + candidate + after) - size(before + after)

    def is_novel(self, text: str, start: int, end: int) -> bool:
        candidate, n = text[start:end], end - start
        before, after = text[max(0, start - self.context - n) : start], text[end : end + self.context + n]
        # Copies go, and at the far ends what may be a part of one.
        before = before.replace(candidate, "")[n if start > self.context + n else 0 :]
        after = after.replace(candidate, "")[: -n if end + self.context + n < len(text) else None]
        before, after = before[-self.context :], after[: self.context]
        return self.marginal(before, candidate, after) >= NOVELTY * len(candidate)


def base_spans(text: str, lower: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed kinds. ``lower``: the text in lower case, for hints only."""
    found = []
    if any(h in lower for h in ASSIGN_HINTS):
        found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX_LONG.finditer(text)]
    return sorted(found)


def candidates(text: str, reach: int = REACH) -> list[tuple[int, int]]:
    """Places of the strings in a sensitive context, in order."""
    found = []
    for run in CANDIDATE.finditer(text):
        start, end = run.span()
        ahead = SENSITIVE.search(text, max(0, start - reach - LONGEST_WORD), start)
        while ahead and ahead.end() < start - reach:
            ahead = SENSITIVE.search(text, ahead.end(), start)
        if not ahead:
            words = SENSITIVE.finditer(text, max(0, start - LONGEST_WORD), end)
            inside = next((m for m in words if m.end() > start), None)
            if not inside:
                continue
            start = end - len(text[inside.end() : end].lstrip(JOINTS))
        if end - start >= LEAST_RUN:
            found.append((start, end))
    return found


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty) -> list[tuple[int, int, int]]:
    # The ends of the fixed spans, as a running maximum: a span that begins before e clashes if it ends behind s.
    starts = [s for s, _, _ in base]
    ends = list(accumulate((e for _, _, e in base), max))

    def clash(s: int, e: int) -> bool:
        k = bisect_left(starts, e)
        return k > 0 and ends[k - 1] > s

    near = [(s, e) for s, e in candidates(text, novelty.reach) if not clash(s, e)]
    novel = {text[s:e] for s, e in near if novelty.is_novel(text, s, e)}
    if not novel:
        return []
    copies = {run.span() for run in CANDIDATE.finditer(text) if run[0] in novel and not clash(*run.span())}
    return sorted((s, 3, e) for s, e in copies.union(x for x in near if text[x[0] : x[1]] in novel))


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every covered stretch replaced by one mask."""
    out, end = [], 0
    for s, _, e in sorted(spans):
        if s >= end or not out:
            out += [text[end:s], MASK]
        end = max(end, e)
    return "".join([*out, text[end:]])


FIELDS = T.StructType(
    [
        T.StructField("n_assign", T.LongType()),
        T.StructField("n_access", T.LongType()),
        T.StructField("n_hex", T.LongType()),
        T.StructField("n_novel", T.LongType()),
        T.StructField("base_sha256", T.StringType()),
        T.StructField("spans", T.StringType()),
        T.StructField("masked_text", T.StringType()),
    ]
)


def scan_text(text: str | None, novelty: Novelty, mask: bool = False) -> tuple:
    text = text or ""
    lower = text.lower()
    base = base_spans(text, lower)
    every = list(base)
    if any(h in lower for h in SENSITIVE_HINTS):
        every += novel_spans(text, base, novelty)
    counts = [sum(k == i for _, k, _ in every) for i in range(4)]
    digest = hashlib.sha256(render(base).encode()).hexdigest()
    return (*counts, digest, render(every), masked(text, every) if mask else None)


def scan(
    docs: DataFrame,
    keep: list[str],
    text_col: str = "text",
    mask: bool = False,
    vocabulary: str | None = None,
    reach: int = REACH,
    context: int = CONTEXT,
) -> DataFrame:
    """The columns in ``keep`` of every row, with the counts, digest and spans; ``masked_text`` is
    filled if ``mask`` is set. ``vocabulary``: file of words for the dictionary."""
    primed = docs.sparkSession.sparkContext.broadcast(primer.dictionary(vocabulary))

    def make():
        novelty = Novelty(primed.value, reach, context)

        def apply(texts):
            return list(zip(*(scan_text(t, novelty, mask) for t in texts), strict=True))

        return apply

    fields = FIELDS if mask else T.StructType(FIELDS.fields[:-1])
    if not mask:
        inner = make

        def make():  # noqa: F811
            apply = inner()
            return lambda texts: apply(texts)[:-1]

    return map_texts(docs, make, keep, text_col, fields)
