"""Token counts by the whole-token shortcut; see :class:`strandweave.llm.tokens.ByteCounts`.

Scale: one pass without a shuffle; whole texts are counted; each worker's table is bounded.

Defined cases: null text counts as empty: 0 bytes, 0 tokens; strings of special tokens inside a text
are the special token, as the library reads them by default; texts that mix scripts are counted by the
library only around the odd characters; repeated rows come back repeated; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts
from .tokens import byte_counts, prove

LIMIT = 512


def count_tokens(docs: DataFrame, vocabulary: str, keep: list[str], text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """The columns in ``keep`` of every row, n_bytes, n_tokens and over_limit."""
    # Proved once, here; what the workers get is the set of at most as many strings as the vocabulary has.
    proven = docs.sparkSession.sparkContext.broadcast(prove(vocabulary))

    def make():
        count = byte_counts(vocabulary, proven.value)
        return lambda texts: ([len((t or "").encode("utf-8")) for t in texts], count.many([t or "" for t in texts]))

    out = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return map_texts(docs, make, keep, text_col, out).withColumn("over_limit", F.col("n_tokens") > limit)
