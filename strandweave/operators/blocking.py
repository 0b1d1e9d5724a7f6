"""Candidate generation: six key rules over a country-partitioned inverted index, as joins.

The index is a table of postings (country, rule, key, candidate), repeated tokens included. Queries
explode into keys of the same shape; one equi-join and one grouped aggregate give hits, scores and
reasons, and a window keeps the best k candidates of each query. Queries from a country that the pool
doesn't have join on (rule, key) alone, and so reach all countries.

Scale: what is joined and shuffled are key rows without texts; keys whose postings exceed their cap
are dropped before the join, by a count that is pre-aggregated. Rules 1, 3 and 4 have no cap, and one key
of theirs may have any number of postings. The best k are found without joining those: an entity has at
most one key of these rules and one postal code, and candidates that share the same of these keys with a
query, and are hit by no other rule, differ by ``cand_idx`` alone. So of each set of keys (country,
compact name, number and street, plot, code; any part of them) the first k candidates are listed, and a
query takes the lists of its sets. Whoever is left out of the list of its own set has k others before it
that share these keys at least. Only :func:`key_matches`, whose result is every hit, joins hot keys; they
are left to Spark's skew-join splitting.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import cut_lineage

#: Rule numbers by reason, in the order in which the rules are applied.
RULES = {"compact_name": 1, "token_overlap": 2, "num_street": 3, "plot_num": 4, "postal": 5, "addr_tokens": 6}
#: Points of a rule; of 2 and 6 for each hit.
POINTS = {1: 12, 2: 5, 3: 6, 4: 6, 5: 4, 6: 4}
NAME_TOKEN_LEAST, ADDR_TOKEN_LEAST = 3, 4
#: Rules whose keys are joined, and the one that is compared in the pairs found.
JOINED, POSTAL = (1, 2, 3, 4, 6), 5
#: Rules of which an entity has one key at most, with its column; and sets of them that make a candidate.
SINGLE = {1: "n_compact", 3: "a_num_word", 4: "a_plot", 5: "a_postal"}
PATTERNS = [p for n in range(1, len(SINGLE) + 1) for p in combinations(SINGLE, n) if p != (POSTAL,)]
#: Rules of which an entity has many keys, all capped.
MANY = (2, 6)
#: Tables of so many rows at most are sent to all executors.
SMALL_ROWS = 50_000
#: Added to the candidates of a later source, so that they follow those of the earlier ones.
SOURCE_STRIDE = 1 << 40


@dataclass(frozen=True)
class BlockingConfig:
    k: int = 15
    max_postings: int = 500
    max_addr_postings: int = 200
    addr_hits: int = 2


def candidate_pool(second: DataFrame, third: DataFrame) -> DataFrame:
    """Both candidate sources one after the other; ``cand_idx`` keeps that order."""
    number = lambda df, n: df.withColumn("cand_idx", F.col("row_id") + F.lit(n * SOURCE_STRIDE)).withColumn("entity_id", F.trim("entity_id"))
    return number(second, 0).unionByName(number(third, 1))


def _keys(rules=tuple(POINTS)) -> Column:
    entry = lambda rule, key, pos: F.struct(F.lit(rule).alias("rule"), key.alias("key"), pos.cast("int").alias("pos"))
    def single(rule: int, column: str) -> Column:
        return F.filter(F.array(entry(rule, F.col(column), F.lit(0))), lambda e: e["key"] != "")

    def many(rule: int, column: str, least: int) -> Column:
        return F.filter(F.transform(column, lambda t, i: entry(rule, t, i)), lambda e: F.length(e["key"]) >= least)

    every = {
        1: single(1, "n_compact"),
        2: many(2, "n_tokens", NAME_TOKEN_LEAST),
        3: single(3, "a_num_word"),
        4: single(4, "a_plot"),
        5: single(5, "a_postal"),
        6: many(6, "a_tokens", ADDR_TOKEN_LEAST),
    }
    return F.concat(*[every[r] for r in rules])


def postings(pool: DataFrame) -> DataFrame:
    """``country, rule, key, cand_idx``; one row for each occurrence."""
    return pool.select("country", "cand_idx", F.inline(_keys())).drop("pos")


def posting_sizes(posts: DataFrame) -> DataFrame:
    return posts.groupBy("country", "rule", "key").agg(F.count("*").alias("n"))


def _over_cap(posts: DataFrame, config: BlockingConfig) -> DataFrame:
    cap = F.when(F.col("rule").isin(2, 5), config.max_postings).when(F.col("rule") == 6, config.max_addr_postings)
    return posting_sizes(posts.filter(F.col("rule").isin(2, 5, 6))).filter(F.col("n") > cap).drop("n")


def capped_postings(posts: DataFrame, config: BlockingConfig) -> DataFrame:
    """Without the keys that exceed their cap (rules 2, 5 and 6)."""
    return posts.join(_over_cap(posts, config), ["country", "rule", "key"], "left_anti")


def query_keys(queries: DataFrame, rules=tuple(POINTS)) -> DataFrame:
    """``q_row, country, min_hits, postal, rule, key, pos``."""
    need = F.when(F.size("n_tokens") <= 2, 1).otherwise(2)
    return queries.select(F.col("row_id").alias("q_row"), "country", need.alias("min_hits"), F.col("a_postal").alias("postal"), F.inline(_keys(rules)))


def key_matches(queries: DataFrame, pool: DataFrame, config: BlockingConfig, rules=JOINED) -> DataFrame:
    """``q_row, cand_idx, rule, pos, min_hits, country_first, same_postal``; one row for each hit of a key."""
    # Written once: the postings are counted for the caps, and joined by two routes.
    every = cut_lineage(pool.select("country", "cand_idx", "a_postal", F.inline(_keys())).drop("pos"))
    over = cut_lineage(_over_cap(every, config))
    # A code over its cap is no code.
    hot = over.filter(F.col("rule") == POSTAL).select("country", F.col("key").alias("a_postal"), F.lit(True).alias("_hot"))
    posts = every.filter(F.col("rule").isin(*rules)).join(over, ["country", "rule", "key"], "left_anti")
    posts = posts.join(hot, ["country", "a_postal"], "left")
    posts = posts.withColumn("_code", F.when(F.col("_hot").isNull() & (F.col("a_postal") != ""), F.col("a_postal"))).drop("a_postal", "_hot")
    countries = pool.groupBy("country").agg(F.min("cand_idx").alias("country_first"))
    keys = query_keys(queries, rules)
    known = keys.join(countries, "country").join(posts, ["country", "rule", "key"])
    # Other countries: their keys meet the postings of all.
    foreign = keys.join(countries, "country", "left_anti").drop("country")
    unknown = foreign.join(posts, ["rule", "key"]).join(countries, "country")
    same = F.coalesce(F.col("_code") == F.col("postal"), F.lit(False)).alias("same_postal")
    cols = ["q_row", "cand_idx", "rule", "pos", "min_hits", "country_first", same]
    return known.select(*cols).unionByName(unknown.select(*cols))


def _points(t: DataFrame, config: BlockingConfig) -> DataFrame:
    """``q_row, cand_idx, score, reasons`` and the order of first insertion, out of the hits of each pair."""
    kept = {r: F.col(f"h{r}") > 0 for r in (1, 3, 4)}
    kept[2] = F.col("h2") >= F.col("min_hits")
    kept[6] = F.col("h6") >= config.addr_hits
    # The postal rule only adds to candidates that an earlier rule has found.
    kept[5] = F.col("same_postal") & (kept[1] | kept[2] | kept[3] | kept[4])
    points = [F.when(kept[r], POINTS[r] * (F.col(f"h{r}") if r in (2, 6) else 1)).otherwise(0) for r in sorted(kept)]
    reasons = F.array_compact(F.array(*[F.when(kept[r], F.lit(name)) for name, r in sorted(RULES.items())]))
    first = F.coalesce(*[F.when(kept[r], F.lit(r)) for r in (1, 2, 3, 4, 6)])
    place = F.when(first == 2, F.col("p2")).when(first == 6, F.col("p6")).otherwise(0)
    return t.select(
        "q_row",
        "cand_idx",
        sum(points[1:], points[0]).cast("long").alias("score"),
        F.array_join(reasons, ",").alias("reasons"),
        "country_first",
        first.alias("first_rule"),
        place.alias("first_pos"),
    ).filter(F.col("first_rule").isNotNull())


def _hit_columns(rules) -> list[Column]:
    """Hits by rule, the first place of a token, and what holds for all hits of a pair."""
    of = lambda rule: F.col("rule") == rule
    return [
        *[F.count_if(of(r)).alias(f"h{r}") for r in rules],
        *[F.min(F.when(of(r), F.col("pos"))).alias(f"p{r}") for r in MANY],
        F.max("min_hits").alias("min_hits"),
        F.min("country_first").alias("country_first"),
    ]


def scored(matches: DataFrame, config: BlockingConfig) -> DataFrame:
    """``q_row, cand_idx, score, reasons`` and the order of first insertion, of every candidate."""
    return _points(matches.groupBy("q_row", "cand_idx").agg(*_hit_columns(JOINED), F.max("same_postal").alias("same_postal")), config)


def _small(df: DataFrame) -> DataFrame:
    """``df``, which is written already, marked to be broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def _patterns() -> Column:
    """Of each set of single keys that are there: its bits, and the keys ('' for the others)."""
    there = lambda p: ~F.lit("").isin(*[F.col(SINGLE[r]) for r in p])
    entry = lambda p: F.struct(F.lit(sum(1 << r for r in p)).alias("bits"), *[(F.col(c) if r in p else F.lit("")).alias(f"k{r}") for r, c in SINGLE.items()])
    return F.array_compact(F.array(*[F.when(there(p), entry(p)) for p in PATTERNS]))


def _first_by_keys(pool: DataFrame, k: int) -> DataFrame:
    """``country, bits, k1, k3, k4, k5, cands``: of each set of keys the first k candidates that have them."""
    group = ["country", "bits", *[f"k{r}" for r in SINGLE]]
    place = F.row_number().over(Window.partitionBy(*group).orderBy("cand_idx"))
    first = pool.select("country", "cand_idx", F.inline(_patterns())).withColumn("_p", place).filter(F.col("_p") <= k)
    return first.groupBy(*group).agg(F.collect_list("cand_idx").alias("cands"))  # k at most


def _best_matches(queries: DataFrame, pool: DataFrame, config: BlockingConfig) -> DataFrame:
    """``q_row, cands, rule, pos, min_hits, country_first, bits``: every hit of a capped token, and the
    first k candidates by single keys. ``bits`` has the single keys that all of ``cands`` share."""
    every = pool.select("country", "cand_idx", F.inline(_keys((*MANY, POSTAL)))).drop("pos")
    over = _small(cut_lineage(_over_cap(every, config)))
    countries = _small(cut_lineage(pool.groupBy("country").agg(F.min("cand_idx").alias("country_first"))))
    # A code over its cap is no code.
    hot = over.filter(F.col("rule") == POSTAL).select("country", F.col("key").alias("a_postal"), F.lit(True).alias("_hot"))
    coded = lambda df: df.join(hot, ["country", "a_postal"], "left").withColumn("a_postal", F.when(F.col("_hot").isNull(), F.col("a_postal")).otherwise("")).drop("_hot")
    own = lambda prefix: [F.col(c).alias(f"{prefix}{r}") for r, c in SINGLE.items()]
    capped = lambda df: df.join(over, ["country", "rule", "key"], "left_anti")
    pool = coded(pool.select("country", "cand_idx", "n_tokens", "a_tokens", *SINGLE.values()))
    posts = capped(pool.select("country", "cand_idx", *own("c"), F.inline(_keys(MANY)).alias("rule", "key", "_pos"))).drop("_pos")
    lists = _first_by_keys(pool, config.k)

    need = F.when(F.size("n_tokens") <= 2, 1).otherwise(2).alias("min_hits")
    asked = queries.select(F.col("row_id").alias("q_row"), "country", need, "n_tokens", "a_tokens", *SINGLE.values())
    same = lambda r: F.when((F.col(f"q{r}") != "") & (F.col(f"q{r}") == F.col(f"c{r}")), 1 << r).otherwise(0)
    shared = sum((same(r) for r in list(SINGLE)[1:]), same(next(iter(SINGLE))))
    rest = ["min_hits", "country_first"]

    def hits(asked: DataFrame, known: bool) -> DataFrame:
        at = ["country"] if known else []
        tokens = asked.select("q_row", *at, "min_hits", *own("q"), F.inline(_keys(MANY)))
        tokens = capped(tokens) if known else tokens
        singles = asked.select("q_row", *at, "min_hits", F.inline(_patterns()))
        by_token = tokens.join(posts, [*at, "rule", "key"]).join(countries, "country")
        by_single = singles.join(lists, [*at, "bits", *[f"k{r}" for r in SINGLE]]).join(countries, "country")
        return by_token.select("q_row", F.array("cand_idx").alias("cands"), "rule", "pos", *rest, shared.alias("bits")).unionByName(
            by_single.select("q_row", "cands", F.lit(0).alias("rule"), F.lit(0).alias("pos"), *rest, "bits")
        )

    found = hits(coded(asked.join(countries.select("country"), "country", "left_semi")), True)
    # Queries of other countries meet the candidates of all.
    foreign = asked.join(countries.select("country"), "country", "left_anti")
    return found if foreign.isEmpty() else found.unionByName(hits(foreign.drop("country"), False))


def top_candidates(queries: DataFrame, pool: DataFrame, config: BlockingConfig = BlockingConfig()) -> DataFrame:
    """``q_row, cand_idx, rank, score, reasons`` of the best k candidates of each query."""
    # Dealt out by query once, for the aggregate and the window.
    matches = _best_matches(queries, pool, config).repartition("q_row").withColumn("cand_idx", F.explode("cands"))
    t = matches.groupBy("q_row", "cand_idx").agg(*_hit_columns(MANY), F.bit_or("bits").alias("bits"))
    has = lambda r: F.col("bits").bitwiseAND(1 << r) != 0
    t = t.withColumns({f"h{r}": has(r).cast("int") for r in SINGLE if r != POSTAL} | {"same_postal": has(POSTAL)})
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), "country_first", "first_rule", "first_pos", "cand_idx")
    ranked = _points(t, config).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= config.k).select("q_row", "cand_idx", "rank", "score", "reasons")


def candidate_pairs(queries: DataFrame, pool: DataFrame, config: BlockingConfig = BlockingConfig()) -> DataFrame:
    """Top candidates with both entity ids: ``q_row, s1_id, cand_idx, cand_id, rank, score, reasons``."""
    top = top_candidates(queries, pool, config)
    left = queries.select(F.col("row_id").alias("q_row"), F.col("entity_id").alias("s1_id"))
    right = pool.select("cand_idx", F.col("entity_id").alias("cand_id"))
    return top.join(left, "q_row").join(right, "cand_idx").select("q_row", "s1_id", "cand_idx", "cand_id", "rank", "score", "reasons")


def id_lists(queries: DataFrame, pairs: DataFrame, out: str, dedupe: bool = False) -> DataFrame:
    """One row per query row, with its pairs' candidate ids by rank, comma-joined ('' if none)."""
    lists = pairs.groupBy("q_row").agg(F.array_sort(F.collect_list(F.struct("rank", "cand_id"))).alias("l"))  # k at most
    ids = F.transform("l", lambda x: x["cand_id"])
    ids = F.array_distinct(ids) if dedupe else ids
    rows = queries.select(F.col("row_id").alias("q_row"), F.col("entity_id").alias("source1_entity_id"))
    return rows.join(lists, "q_row", "left").select("q_row", "source1_entity_id", F.coalesce(F.array_join(ids, ","), F.lit("")).alias(out))
