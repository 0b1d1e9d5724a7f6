"""The relational blocking plan against a record-at-a-time model on random pools."""

from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strandweave.operators.blocking import BlockingConfig, capped_postings, id_lists, postings, top_candidates

TOKENS = ["abc", "abd", "bcde", "cdef", "xy", "longer"]
record = st.tuples(
    st.lists(st.sampled_from(TOKENS), max_size=4), st.sampled_from(["", "1_main", "2_main"]), st.sampled_from(["", "1-2"]),
    st.sampled_from(["", "11111", "22222"]), st.lists(st.sampled_from(TOKENS), max_size=4), st.sampled_from(["us", "fr", "in"]),
)
SCHEMA = "n_tokens array<string>, a_num_word string, a_plot string, a_postal string, a_tokens array<string>, country string, n_compact string"


def model(queries, pool, config):
    out = []
    countries = list(dict.fromkeys(r[5] for r in pool))
    size = defaultdict(int)
    for tokens, _, _, postal, address, country in pool:
        for t in tokens:
            size[country, 2, t] += 1
        size[country, 5, postal] += 1
        for t in address:
            size[country, 6, t] += 1
    for q, (tokens, street, plot, postal, address, country) in enumerate(queries):
        score, why = {}, defaultdict(set)

        def add(c, points, reason, score=score, why=why):
            score[c] = score.get(c, 0) + points
            why[c].add(reason)

        for place in [country] if country in countries else countries:
            own = [(i, r) for i, r in enumerate(pool) if r[5] == place]
            compact = "".join(tokens)
            for i, r in own:
                if compact and "".join(r[0]) == compact:
                    add(i, 12, "compact_name")
            for column, least, cap, rule, points, reason in ((0, 3, config.max_postings, 2, 5, "token_overlap"), (4, 4, config.max_addr_postings, 6, 4, "addr_tokens")):
                if rule == 6:
                    for i, r in own:
                        if street and r[1] == street:
                            add(i, 6, "num_street")
                    for i, r in own:
                        if plot and r[2] == plot:
                            add(i, 6, "plot_num")
                    for i, r in own:
                        if postal and r[3] == postal and size[place, 5, postal] <= config.max_postings and i in score:
                            add(i, 4, "postal")
                hits = {}
                for t in (tokens, None, None, None, address)[column]:
                    if len(t) >= least and size[place, rule, t] <= cap:
                        for i, r in own:
                            for x in r[column]:
                                if x == t:
                                    hits[i] = hits.get(i, 0) + 1
                need = 2 if rule == 6 or len(tokens) > 2 else 1
                for i, n in hits.items():
                    if n >= need:
                        add(i, points * n, reason)
        best = sorted(score.items(), key=lambda x: -x[1])[: config.k]
        out += [(q, i, rank, s, ",".join(sorted(why[i]))) for rank, (i, s) in enumerate(best, 1)]
    return out


def frames(spark, queries, pool):
    rows = lambda records: [(i, f"S-{i}", *r, "".join(r[0])) for i, r in enumerate(records)]
    return (
        spark.createDataFrame(rows(queries), f"row_id long, entity_id string, {SCHEMA}"),
        spark.createDataFrame(rows(pool), f"cand_idx long, entity_id string, {SCHEMA}"),
    )


@settings(max_examples=6, deadline=None, derandomize=True, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(record, min_size=1, max_size=25), st.lists(record, max_size=25))
def test_top_candidates(spark, queries, pool):
    # One query from a country that the pool doesn't have.
    queries = [*queries, (*queries[0][:5], "zz")]
    config = BlockingConfig(k=5, max_postings=6, max_addr_postings=4)
    got = top_candidates(*frames(spark, queries, pool), config).collect()
    assert sorted((r.q_row, r.cand_idx, r["rank"], r.score, r.reasons) for r in got) == sorted(model(queries, pool, config))


def test_caps_and_lists(spark):
    pool = [(["abc"], "", "", "", [], "us")] * 4 + [(["abd"], "", "", "", [], "us")]
    queries, candidates = frames(spark, [(["abc"], "", "", "", [], "us"), ([], "", "", "", [], "us")], pool)
    posts = postings(candidates)
    assert capped_postings(posts, BlockingConfig(max_postings=3)).filter("rule = 2").count() == 1
    top = top_candidates(queries, candidates, BlockingConfig(k=2)).join(candidates.selectExpr("cand_idx", "entity_id as cand_id"), "cand_idx")
    lists = {r.q_row: r.ids for r in id_lists(queries, top, "ids").collect()}
    assert lists == {0: "S-0,S-1", 1: ""}


@pytest.mark.parametrize("side", ["queries", "pool"])
def test_empty_side(spark, side):
    one = [(["abc"], "", "", "", [], "us")]
    queries, pool = frames(spark, [] if side == "queries" else one, [] if side == "pool" else one)
    assert top_candidates(queries, pool).count() == 0


def most_rows(frame):
    """Collects ``frame``; the most rows that a node of its plan gave out."""
    frame.collect()
    most, nodes = 0, [frame._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        kind = node.getClass().getSimpleName()
        found = node.metrics().get("numOutputRows")
        most = max(most, found.get().value() if found.isDefined() else 0)
        inner = node.executedPlan() if kind == "AdaptiveSparkPlanExec" else node.plan() if kind.endswith("QueryStageExec") else None
        children = node.children()
        nodes += [inner] if inner is not None else [children.apply(i) for i in range(children.size())]
    return most


def test_hot_keys_without_a_cap_are_not_joined(spark):
    """200 queries and 200 candidates share a street and a plot: 40,000 pairs, of which 400 are wanted."""
    many = [(["abc"], "1_main", "1-2", "", [], "us")] * 200
    queries, pool = frames(spark, many, many)
    top = top_candidates(queries, pool, BlockingConfig(k=2, max_postings=10))
    assert most_rows(top) < 10_000
    assert sorted((r.q_row, r.cand_idx, r.score) for r in top.collect()) == [(q, c, 24) for q in range(200) for c in (0, 1)]
