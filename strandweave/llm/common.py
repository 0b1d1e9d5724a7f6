"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..sources.scratch import cut_lineage, shared_folder

#: Characters that part words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_BREAK = r"[\x20\x09-\x0D]+"
#: Texts handed to one call of a text function; bounds a worker's memory.
SLICE_ROWS = 128


#: Rows and bytes of a narrow table that may be broadcast.
SMALL_ROWS, SMALL_BYTES = 50_000, 16 << 20


def small_or_shuffled(df: DataFrame) -> DataFrame:
    """``df``, a narrow table behind :func:`cut_lineage`, with a broadcast hint if its rows and bytes,
    both counted, are few."""
    texts = [F.coalesce(F.length(F.col(f.name).cast("binary")), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    wide = sum(texts, F.lit(0)) + 16 * len(df.columns)
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(wide), F.lit(0))).first()
    return F.broadcast(df) if rows <= SMALL_ROWS and size <= SMALL_BYTES else df


__all__ = ["Many", "crc_fold", "cut_lineage", "map_texts", "read_table", "shared_folder", "small_or_shuffled", "words"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def words(text: Column) -> Column:
    """Array of the maximal runs of characters other than ASCII white space; null text: empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")


def map_texts(
    df: DataFrame,
    make: Callable[[], Callable[[list[str | None]], Sequence]],
    keep: Sequence[str],
    text_col: str,
    out: T.StructType,
    keep_text: bool = False,
) -> DataFrame:
    """Apply a batch text function on the executors, without a shuffle.

    ``make()`` runs once a task and returns ``f(texts) -> one sequence per field of out``, or, for
    an operator that returns several rows a text, a pair ``(row numbers, sequences)`` wrapped in
    :class:`Many`. The columns named in ``keep`` are copied to the result.
    """
    cols = list(dict.fromkeys([*keep, text_col]))
    kept = [c for c in cols if c != text_col or keep_text or text_col in keep]
    schema = T.StructType([*(f for f in df.select(*kept).schema.fields), *out.fields])
    arrow = to_arrow_schema(schema)
    text_at = cols.index(text_col)
    kept_at = [cols.index(c) for c in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                got = apply(part.column(text_at).to_pylist())
                left = [part.column(i) for i in kept_at]
                if isinstance(got, Many):
                    rows = pa.array(got.rows, pa.int64())
                    left, got = [c.take(rows) for c in left], got.columns
                right = [
                    c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                    for c, f in zip(got, list(arrow)[len(kept) :], strict=True)
                ]
                left = [c.cast(f.type) for c, f in zip(left, arrow, strict=False)]
                yield pa.RecordBatch.from_arrays([*left, *right], schema=arrow)
            # A worker lives on after its task: what a large batch took goes back to the machine.
            pa.default_memory_pool().release_unused()

    return df.select(*cols).mapInArrow(run, schema)


class Many:
    """Several output rows a text: the text's row number in its slice, and the columns."""

    def __init__(self, rows, columns):
        self.rows, self.columns = rows, columns
