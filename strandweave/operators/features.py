"""Thirty features of a candidate pair."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import similarity as S
from ..functions.text import NORMAL_COLUMNS
from ..sources.scratch import cut_lineage
from .blocking import RULES

# The features in the order of the matrix.
FEATURE_NAMES = [
    "name_exact", "name_compact_match", "name_token_jaccard", "name_token_overlap_cnt", "name_overlap_coeff",
    "name_char3_jaccard", "name_char3_cosine", "name_seq_ratio", "name_jaro_winkler", "name_token_sort",
    "name_token_set", "name_len_diff_ratio",
    "addr_exact", "addr_token_jaccard", "addr_overlap_coeff", "addr_char3_jaccard", "addr_char3_cosine",
    "addr_seq_ratio", "addr_jaro_winkler", "addr_token_sort", "addr_len_diff_ratio",
    "postal_match", "num_word_match",
    "blocking_score", "reason_compact_name", "reason_token_overlap", "reason_num_street", "reason_plot_num",
    "reason_postal", "reason_addr_tokens",
]


def joined_pairs(pairs: DataFrame, queries: DataFrame, pool: DataFrame, tasks: int | None = None) -> DataFrame:
    """Pairs with the normalised columns and three-grams of both sides as ``l_*`` and ``r_*``; dealt to so
    many tasks, if given."""
    side = lambda df, key, name, p: df.select(F.col(key).alias(name), *[F.col(c).alias(f"{p}_{c}") for c in NORMAL_COLUMNS])
    joined = pairs.join(side(queries, "row_id", "q_row", "l"), "q_row").join(side(pool, "cand_idx", "cand_idx", "r"), "cand_idx")
    joined = joined.repartition(tasks, "q_row", "cand_idx") if tasks else joined
    # Columns of their own, since each is used several times.
    return joined.withColumns({f"{s}_{p}_grams": F.array_distinct(S.grams(F.col(f"{s}_{c}"))) for s in "lr" for p, c in (("name", "n_text"), ("addr", "a_text"))})


def native_features() -> dict[str, Column]:
    """The features that need no Python."""
    left, right = (lambda c: F.col(f"l_{c}")), (lambda c: F.col(f"r_{c}"))
    both = lambda c: (left(c), right(c))
    same = lambda c: ((left(c) != "") & (left(c) == right(c))).cast("double")
    reasons = F.split("reasons", ",")
    out = {
        "name_exact": same("n_text"),
        "name_compact_match": same("n_compact"),
        "name_token_overlap_cnt": F.size(F.array_intersect(*both("n_tokens"))).cast("double"),
        "addr_exact": same("a_text"),
        "postal_match": S.agreement(*both("a_postal")),
        "num_word_match": S.agreement(*both("a_num_word")),
        "blocking_score": F.when(F.col("reasons") == "", 0).otherwise(F.size(reasons)).cast("double"),
    }
    for p, text, tokens in (("name", "n_text", "n_tokens"), ("addr", "a_text", "a_tokens")):
        out |= {
            f"{p}_token_jaccard": S.jaccard(*both(tokens)),
            f"{p}_overlap_coeff": S.overlap_coefficient(*both(tokens)),
            f"{p}_char3_jaccard": S.jaccard(F.col(f"l_{p}_grams"), F.col(f"r_{p}_grams")),
            f"{p}_char3_cosine": S.gram_cosine(*both(text)),
            f"{p}_seq_ratio": S.char_ratio(*both(text)),
            f"{p}_len_diff_ratio": S.length_gap(*both(text)),
        }
    return out | {f"reason_{r}": F.array_contains(reasons, r).cast("double") for r in RULES}


#: Kinds of pairs that one task measures.
ROWS_PER_TASK = 4_096
#: Columns that the features of names and of addresses are made of.
NAME_COLUMNS, ADDRESS_COLUMNS = ["n_text", "n_tokens", "n_compact"], ["a_text", "a_postal", "a_num_word", "a_tokens"]


def classes(rows: DataFrame, columns: list[str], key: str, name: str) -> DataFrame:
    """``key, name``: ``name`` is the least key of the rows that agree in ``columns``. They are told apart by
    the SHA-256 of their values, so that texts are not shuffled."""
    hashed = rows.select(key, F.unhex(F.sha2(F.to_json(F.struct(*columns)), 256)).alias("_h"))
    return cut_lineage(hashed.join(hashed.groupBy("_h").agg(F.min(key).alias(name)), "_h").select(key, name))


def distinct_features(kinds: DataFrame, queries: DataFrame, pool: DataFrame) -> DataFrame:
    """``kinds`` and the features. Each of its rows (q_kind, cand_kind, reasons) stands for all pairs of the
    same texts and reasons, and the names of many kinds are the same. ``queries`` and ``pool`` have one row for
    each kind."""
    left = classes(queries, NAME_COLUMNS, "row_id", "q_name").withColumnRenamed("row_id", "q_kind")
    right = classes(pool, NAME_COLUMNS, "cand_idx", "cand_name").withColumnRenamed("cand_idx", "cand_kind")
    named = kinds.join(left, "q_kind").join(right, "cand_kind")
    # Measuring takes far longer than the bytes of a pair tell, by which shuffled partitions are put together.
    tasks = math.ceil(kinds.count() / ROWS_PER_TASK) or 1
    # What a part is not made of is blank, and costs nothing.
    blank = lambda df, cols: df.withColumns({c: (F.array() if kind.startswith("array") else F.lit("")).cast(kind) for c, kind in df.dtypes if c in cols})

    def part(pairs: DataFrame, q: str, cand: str, blanks: list[str], wanted: list[str]) -> DataFrame:
        keyed = pairs.withColumns({"q_row": F.col(q), "cand_idx": F.col(cand)})
        made = pair_features(keyed, blank(queries, blanks), blank(pool, blanks), tasks=tasks)
        return made.select(*pairs.columns, *wanted)

    of_name = [f for f in FEATURE_NAMES if f.startswith("name_")]
    names = part(named.select("q_name", "cand_name").distinct().withColumn("reasons", F.lit("")), "q_name", "cand_name", ADDRESS_COLUMNS, of_name).drop("reasons")
    rest = part(named, "q_kind", "cand_kind", NAME_COLUMNS, [f for f in FEATURE_NAMES if f not in of_name])
    return rest.join(names, ["q_name", "cand_name"]).select(*kinds.columns, *FEATURE_NAMES)


def pair_features(pairs: DataFrame, queries: DataFrame, pool: DataFrame, sequence: bool = True, tasks: int | None = None) -> DataFrame:
    """The pair columns and the features, in single precision; without the sequence measures, if they
    aren't wanted, no Python runs."""
    t = joined_pairs(pairs, queries, pool, tasks)
    found = native_features()
    if sequence:
        t = t.withColumn("_seq", S.sequence_measures(*[F.col(c) for c in ("l_n_text", "r_n_text", "l_a_text", "r_a_text")]))
        found |= {f: F.col(f"_seq.{f}") for f in S.SEQUENCE_FIELDS + S.COSINE_FIELDS}
    return t.select(*pairs.columns, *[found[f].cast("float").alias(f) for f in FEATURE_NAMES if f in found])
