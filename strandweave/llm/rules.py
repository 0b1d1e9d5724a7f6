"""Quality rules with adaptive thresholds from mergeable quantile sketches, in SQL functions only.

Each document is measured once: symbols, upper-case letters and repeated lines, in thousandths, and
hundredths of the mean word length. Symbols and repeated lines enter by the lower bound of their count
(three standard errors less), since a few of them say little about a short text. A sketch is a
histogram over logarithmic buckets (exact below 16, then eight to an octave, so a quantile is right to
an eighth of its value). Sketches of one (language, source) are added up from the tasks' partial
counts, and those of a language or of all rows from theirs: addition is all that merging takes, and
the order does not matter.

There are no fixed cutoffs. The limit of a measure lies where the quantile function of a group jumps:
between a tail (``TAIL`` of the documents, from the most to the least common) and the rest there has to
be an octave that holds less than one document for each ``ODDS`` of the tail. Of several such places the
one that parts the most documents counts; a measure that falls off evenly has no limit. A group's
sketch is pooled with that of its language and that of all rows, which weigh ``PRIOR`` documents each,
so that small groups lean on the others by their size and not by a switch.

Two base rules stay fixed: too few words, and too many words in windows that occur twice (so repeated
windows have no adaptive rule besides).

Scale: texts are read once and measured in place, all by expressions over arrays of one document:
windows are 64-bit hashes, distinct ones are counted in linear time, and only documents with a
repeated hash sort theirs (equal hashes are confirmed word by word). What is shuffled are bucket
counts, pre-aggregated in each task; a group has at most a few hundred buckets, and the sketches of a
language and of all rows travel as one array of those. The thresholds (one row a language and source)
are counted and broadcast only if they are few; otherwise the join is shuffled, and Spark splits its
skewed keys.

Defined cases: null text has no words and fails the base rules; very long texts are measured whole;
null languages and sources are groups of their own; ties of two places go to the one that keeps more
documents; repeated rows are judged alike and counted each; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, small_or_shuffled, words

WINDOW = 5
LEAST_WORDS = 10
#: Largest share of words in repeated windows, in hundredths.
MOST_REPEATED = 20
SYMBOLS = "[#*$%&|<>]"
HAS_WORD = r"[^\x20\x09-\x0D]"
#: Measures, and whether the lower side has a limit beside the upper one.
MEASURES = (("symbol_share", False), ("upper_share", False), ("dup_line_share", False), ("mean_word", True))
#: Standard errors by which a count of rare things is lowered.
ERRORS = 3
#: Buckets of the stretch that has to be nearly empty: an octave.
GAP = 8
#: One document in the gap weighs as much as so many of the tail.
ODDS = 20
#: A tail holds one document of 200 at least, and one of 4 at most.
TAIL = (200, 4)
#: Documents that the sketch of the language, and that of all rows, weigh in each group.
PRIOR = 100
#: Units of a document's weight; whole numbers add up exactly in any order.
UNIT = 10_000


def _repeated_words(w: Column, hashes: Column) -> Column:
    """Words covered by windows whose hash occurs twice, given the window hashes."""
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def cover(s: Column) -> Column:
        def same(x: Column, other: Column) -> Column:
            equal = x["h"] == other["h"]
            # Word by word: a slice would copy the whole array each time.
            for k in range(WINDOW):
                equal &= F.get(w, x["i"] + k) == F.get(w, other["i"] + k)
            return equal

        def twice(x: Column, j: Column) -> Column:
            before = F.when(j > 0, same(x, F.get(s, j - 1))).otherwise(False)
            after = F.when(j + 1 < F.size(s), same(x, F.get(s, j + 1))).otherwise(False)
            return before | after

        return F.array_sort(F.transform(F.filter(s, twice), lambda x: x["i"]))

    # A one-element array binds the sorted hashes, and then the positions, to a name.
    places = F.transform(F.array(ordered), cover)
    counts = F.transform(
        places,
        lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)))),
            F.lit(0).cast("long"),
            lambda total, x: total + x,
        ),
    )
    return F.get(counts, F.lit(0))


def measure(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """The columns in ``keep`` of every row, with the counts and measures."""
    text = F.coalesce(F.col("_text"), F.lit(""))
    t = docs.select(*keep, F.col(text_col).alias("_text"))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(HAS_WORD))
    t = t.withColumns({"_w": words(F.col("_text")), "_lines": lines})
    t = t.withColumns(
        {
            "n_words": F.size("_w").cast("long"),
            "word_chars": F.length(F.array_join("_w", "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
            "_upper": (F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}+", ""))).cast("long"),
            "_n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_h": F.transform("_w", lambda x: F.xxhash64(x)),
        }
    )
    span = F.sequence(F.lit(0), F.size("_h") - WINDOW)
    windows = F.transform(span, lambda i: F.xxhash64(*[F.get(F.col("_h"), i + k) for k in range(WINDOW)]))
    t = t.withColumn("_win", F.when(F.size("_h") >= WINDOW, windows).otherwise(F.array().cast("array<long>")))
    t = t.withColumn("_distinct", F.size(F.array_distinct("_win")))
    repeated = F.when(F.col("_distinct") < F.size("_win"), _repeated_words(F.col("_w"), F.col("_win"))).otherwise(0)
    t = t.withColumn("n_repeat_words", repeated.cast("long"))
    share = lambda a, b, k: F.expr(f"({a} * {k}) div greatest({b}, 1)")
    lowered = lambda a: f"greatest({a} - cast(ceil({ERRORS} * sqrt({a})) as bigint), 0)"
    t = t.withColumns(
        {
            "symbol_share": share(lowered("n_symbols"), "word_chars", 1000),
            "upper_share": share("_upper", "word_chars", 1000),
            "dup_line_share": share(lowered("n_dup_lines"), "_n_lines", 1000),
            "mean_word": share("word_chars", "n_words", 100),
            "base_failed": (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")),
        }
    )
    return t.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", *[m for m, _ in MEASURES])


def bucket(v: Column) -> Column:
    """Number of the value's bucket: exact below 16, then eight buckets to an octave."""
    octave = F.length(F.bin(v)) - 1
    log = (octave * 8).cast("long") + F.call_function("shiftright", v, octave - 3).bitwiseAND(F.lit(7).cast("long"))
    return F.when(v < 16, v).otherwise(log)


def bucket_start(b: Column) -> Column:
    """Least value of a bucket."""
    octave = F.floor(b / 8).cast("int")
    return F.when(b < 16, b).otherwise(F.call_function("shiftleft", (b % 8 + 8).cast("long"), octave - 3))


def sketches(measured: DataFrame, lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``lang, source, m, b, n``: the sketch of every measure (by number) of every language and source."""
    pairs = F.array(*[F.struct(F.lit(i).alias("m"), bucket(F.col(m)).alias("b")) for i, (m, _) in enumerate(MEASURES)])
    return (
        measured.select(F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), F.inline(pairs).alias("m", "b"))
        .groupBy("lang", "source", "m", "b")
        .agg(F.count("*").alias("n"))
    )


def _prior(cells: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, prior``: the sketch of each group as an array of (m, b, w) that weighs ``PRIOR`` documents."""
    t = cells.groupBy(*keys, "m", "b").agg(F.sum("n").alias("n"))
    t = t.withColumn("size", F.sum("n").over(Window.partitionBy(*keys, "m")))
    t = t.withColumn("w", F.expr(f"(n * {PRIOR * UNIT}) div size"))
    return t.groupBy(*keys).agg(F.collect_list(F.struct("m", "b", "w")).alias("prior"))  # a few hundred buckets


def pooled(cells: DataFrame) -> DataFrame:
    """``lang, source, m, b, w``: each group's sketch, with those of its language and of all rows."""
    groups = cells.select("lang", "source").distinct()
    by_lang = _prior(cells, ["lang"]).withColumnRenamed("lang", "_l")
    of_lang = groups.join(by_lang, F.col("lang").eqNullSafe(F.col("_l"))).select("lang", "source", F.inline("prior"))
    whole = _prior(cells.withColumn("_all", F.lit(0)), ["_all"]).select("prior").scalar()
    of_all = groups.select("lang", "source", F.inline(whole))
    own = cells.select("lang", "source", "m", "b", (F.col("n") * UNIT).alias("w"))
    every = own.unionByName(of_lang).unionByName(of_all)
    return every.groupBy("lang", "source", "m", "b").agg(F.sum("w").alias("w"))


def thresholds(cells: DataFrame) -> DataFrame:
    """``lang, source`` and, by measure, ``low_<measure>`` (least value kept) and ``high_<measure>``
    (least value beyond those kept); null without a limit."""
    of = Window.partitionBy("lang", "source", "m")
    along = of.orderBy("b")
    t = pooled(cells).withColumns(
        {
            "size": F.sum("w").over(of),
            "upto": F.sum("w").over(along.rangeBetween(Window.unboundedPreceding, 0)),
            "ahead": F.coalesce(F.sum("w").over(along.rangeBetween(-GAP, -1)), F.lit(0)),
            "behind": F.coalesce(F.sum("w").over(along.rangeBetween(1, GAP)), F.lit(0)),
        }
    )

    def parted(tail: Column, gap: Column, b: Column) -> Column:
        fits = (tail * TAIL[0] >= F.col("size")) & (tail * TAIL[1] <= F.col("size")) & (tail > ODDS * gap)
        return F.max(F.when(fits, F.struct((tail - ODDS * gap).alias("net"), b.alias("b"))))

    upper = parted(F.col("size") - F.col("upto") + F.col("w"), F.col("ahead"), F.col("b"))
    lower = parted(F.col("upto"), F.col("behind"), -F.col("b"))
    t = t.groupBy("lang", "source", "m").agg(upper.alias("u"), lower.alias("l"))
    at = lambda i, c: F.max(F.when(F.col("m") == i, c))
    out = []
    for i, (m, two_sided) in enumerate(MEASURES):
        out.append(at(i, bucket_start(F.col("u.b"))).alias(f"high_{m}"))
        if two_sided:
            out.append(at(i, bucket_start(1 - F.col("l.b"))).alias(f"low_{m}"))
    return t.groupBy("lang", "source").agg(*out)


def within_limits() -> dict[str, Column]:
    """By measure, whether a row lies within the limits joined to it."""
    out = {}
    for m, two_sided in MEASURES:
        out[m] = F.coalesce(F.col(m) < F.col(f"high_{m}"), F.lit(True))
        if two_sided:
            out[m] &= F.coalesce(F.col(m) >= F.col(f"low_{m}"), F.lit(True))
    return out


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``id_col``, the counts, base_failed, kept and, by measure, whether it is within its limits."""
    narrow = docs.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"), F.col(source_col).alias("_source"), F.col(text_col).alias("_t"))
    measured = cut_lineage(measure(narrow, ["_id", "_lang", "_source"], "_t"))
    table = cut_lineage(thresholds(sketches(measured, "_lang", "_source")))
    joined = measured.join(small_or_shuffled(table), F.col("_lang").eqNullSafe(F.col("lang")) & F.col("_source").eqNullSafe(F.col("source")))
    within = within_limits()
    kept = ~F.col("base_failed")
    for ok in within.values():
        kept &= ok
    named = [ok.alias(f"{m}_ok") for m, ok in within.items()]
    return joined.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), *named)


def _oracle_sql() -> str:
    names = [m for m, _ in MEASURES]
    long = " union all ".join(f"select r, lang, source, {i} as m, {m} as v from measured" for i, m in enumerate(names))
    start = "case when {0} < 16 then {0} else ({0} % 8 + 8) << (({0} // 8) - 3)::int end"
    lowered = lambda c: f"greatest({c} - ceil({ERRORS} * sqrt({c}))::bigint, 0)"
    prior = lambda keys: f"n * {PRIOR * UNIT} // sum(n) over (partition by {keys}m)"
    fits = lambda tail, gap: f"{tail} * {TAIL[0]} >= size and {tail} * {TAIL[1]} <= size and {tail} > {ODDS} * {gap}"
    side = lambda name, tail, gap, order: f"""
{name} as (select lang, source, m, b from steps where {fits(tail, gap)}
  qualify row_number() over (partition by lang, source, m order by {tail} - {ODDS} * {gap} desc, {order}) = 1)"""  # noqa: E731
    ok = lambda i: f"{names[i]}_ok"
    checks = ", ".join(f"coalesce(bool_and(ok) filter (m = {i}), true) as {ok(i)}" for i in range(len(names)))
    two_sided = ", ".join(str(i) for i, (_, both) in enumerate(MEASURES) if both)
    return f"""
with texts as (select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as text from documents),
split as (
  select r, doc_id, lang, source, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as w,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as lines from texts),
wins as (
  select r, unnest(range(0, len(w) - {WINDOW - 1})) as i,
    unnest(list_transform(range(0, len(w) - {WINDOW - 1}), lambda i: array_to_string(list_slice(w, i + 1, i + {WINDOW}), ' '))) as win
  from split where len(w) >= {WINDOW}),
twice as (select r, i from wins qualify count(*) over (partition by r, win) > 1),
covered as (
  select r, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW}))) as n
  from (select r, i, lead(i) over (partition by r order by i) as nxt from twice) group by r),
counted as (
  select s.r, doc_id, lang, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    len(regexp_extract_all(text, '{SYMBOLS}'))::bigint as n_symbols,
    length(text) - length(regexp_replace(text, '\\p{{Lu}}+', '', 'g')) as n_upper,
    len(lines) as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(c.n, 0)::bigint as n_repeat_words
  from split s left join covered c on s.r = c.r),
measured as (
  select *, n_words < {LEAST_WORDS} or 100 * n_repeat_words > {MOST_REPEATED} * n_words as base_failed,
    {lowered("n_symbols")} * 1000 // greatest(word_chars, 1) as symbol_share, n_upper * 1000 // greatest(word_chars, 1) as upper_share,
    {lowered("n_dup_lines")} * 1000 // greatest(n_lines, 1) as dup_line_share,
    word_chars * 100 // greatest(n_words, 1) as mean_word from counted),
long as (select r, lang, source, m, v::bigint as v from ({long})),
cells as (
  select lang, source, m, case when v < 16 then v else (length(bin(v)) - 1) * 8 + ((v >> (length(bin(v)) - 4)::int) & 7) end as b,
    count(*)::bigint as n from long group by all),
groups as (select distinct lang, source from cells),
by_lang as (select lang, m, b, {prior("lang, ")} as w from (select lang, m, b, sum(n)::bigint as n from cells group by all)),
whole as (select m, b, {prior("")} as w from (select m, b, sum(n)::bigint as n from cells group by all)),
pooled as (
  select lang, source, m, b, sum(w)::bigint as w from (
    select lang, source, m, b, n * {UNIT} as w from cells
    union all select g.lang, g.source, m, b, w from groups g join by_lang l on g.lang is not distinct from l.lang
    union all select lang, source, m, b, w from groups, whole) group by all),
steps as (
  select *, sum(w) over (partition by lang, source, m) as size,
    sum(w) over (partition by lang, source, m order by b) as upto,
    coalesce(sum(w) over (partition by lang, source, m order by b range between {GAP} preceding and 1 preceding), 0) as ahead,
    coalesce(sum(w) over (partition by lang, source, m order by b range between 1 following and {GAP} following), 0) as behind
  from pooled),{side("uppers", "(size - upto + w)", "ahead", "b desc")},{side("lowers", "upto", "behind", "b")},
checked as (
  select x.r, x.m, coalesce(x.v < {start.format("u.b")}, true) and (x.m not in ({two_sided}) or coalesce(x.v >= {start.format("(l.b + 1)")}, true)) as ok
  from long x
  left join uppers u on x.lang is not distinct from u.lang and x.source is not distinct from u.source and x.m = u.m
  left join lowers l on x.lang is not distinct from l.lang and x.source is not distinct from l.source and x.m = l.m),
verdicts as (select r, {checks} from checked group by r)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and {" and ".join(map(ok, range(len(names))))} as kept, {", ".join(map(ok, range(len(names))))}
from measured join verdicts v on measured.r = v.r"""


ORACLE_SQL = _oracle_sql()
