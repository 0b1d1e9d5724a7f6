"""DuckDB SQL for the linkage queries, put together from common table expressions."""

from __future__ import annotations

from ..functions.text import GENERIC_WORDS, LEGAL_SUFFIXES
from ..operators.blocking import RULES, SOURCE_STRIDE
from ..operators.metrics import THRESHOLDS, WEIGHTS
from ..operators.learn import SEED, VALIDATION_SHARE
from .adapters import DOCUMENTS_SQL, PARTS_SQL

_W = r"\p{L}\p{N}_"
_LEFT, _RIGHT = rf"(?:^|[^{_W}])", rf"(?:$|[^{_W}])"
_SINGLE = [s for s in LEGAL_SUFFIXES if " " not in s and "." not in s]
_quote = lambda names: ", ".join(f"'{n}'" for n in names)


def clean(x: str) -> str:
    return f"trim(lower(strip_accents(coalesce({x}, ''))), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


def words(x: str) -> str:
    text = f"regexp_replace({x}, 'https?://\\S+|www\\.\\S+|\\.com|\\.org|\\.in|\\.net|\\.fr', ' ', 'g')"
    text = f"regexp_replace({text}, '[@#()\\[\\]{{}}]', ' ', 'g')"
    text = f"regexp_replace({text}, '\\bl\\.l\\.c\\b', ' ', 'g')"
    text = f"regexp_replace({text}, '[^{_W}\\s]', ' ', 'g')"
    return f"list_filter(string_split_regex({text}, '\\s+'), lambda t: t <> '' and t not in ({_quote(_SINGLE)}))"


def core(x: str) -> str:
    return f"list_filter({x}, lambda t: t not in ({_quote(GENERIC_WORDS)}))"


def postal(x: str) -> str:
    last = lambda p: f"nullif(regexp_extract_all({x}, '{p}')[-1], '')"
    return f"coalesce({last(r'\b[1-9][0-9]{5}\b')}, {last(r'\b[0-9]{5}\b')}, '')"


def street(x: str) -> str:
    p = rf"{_LEFT}(\p{{Nd}}+)\s+([a-z]{{3,}}){_RIGHT}"
    get = lambda i: f"regexp_extract({x}, '{p}', {i})"
    return f"case when {get(2)} = '' then '' else ltrim({get(1)}, '0') || '_' || {get(2)} end"


def plot(x: str) -> str:
    return f"regexp_extract({x}, '{_LEFT}([0-9]+[-/][0-9a-z/-]*[0-9a-z]){_RIGHT}', 1)"


def address_tokens(x: str) -> str:
    parts = f"string_split_regex(regexp_replace({x}, '[^{_W}\\s]', ' ', 'g'), '\\s+')"
    return f"list_filter({parts}, lambda t: length(t) >= 3 and not regexp_full_match(t, '\\p{{Nd}}+') and t not in ({_quote(GENERIC_WORDS)}))"


def base(sql: str = PARTS_SQL, foreign: bool = False) -> str:
    """CTEs up to the postings: rows, normal, pool, queries, posts, qkeys."""
    country = "case when entity_id like 'S1-%' and row_id % 6 = 0 then 'Atlantis' else country end" if foreign else "country"
    return f"""
raw as ({sql}),
cleaned as (select row_id, entity_id, {clean("business_name")} as nm, {clean("business_address")} as a_text, {clean(country)} as country from raw),
worded as (select *, {words("nm")} as ws from cleaned),
normal as (
  select row_id, entity_id, array_to_string(ws, ' ') as n_text, {core("ws")} as n_tokens, array_to_string({core("ws")}, '') as n_compact,
    a_text, {postal("a_text")} as a_postal, {street("a_text")} as a_num_word, {plot("a_text")} as a_plot, {address_tokens("a_text")} as a_tokens, country
  from worded),
queries as (select row_id as q_row, * from normal where entity_id like 'S1-%'),
pool as (select row_id + case when entity_id like 'S3-%' then {SOURCE_STRIDE} else 0 end as cand_idx, * from normal where entity_id not like 'S1-%'),
{_keys("posts", "pool", "cand_idx")},
{_keys("qkeys", "queries", "q_row")},
sizes as (select country, rule, key, count(*) as n from posts group by all),
capped as (
  select p.* from posts p join sizes s using (country, rule, key)
  where (rule in (2, 5) and n <= 500) or (rule = 6 and n <= 200) or rule in (1, 3, 4)),
countries as (select country, min(cand_idx) as country_first from pool group by country)"""


def _keys(name: str, table: str, key: str) -> str:
    single = lambda rule, c: f"select country, {key}, {rule} as rule, {c} as key, 0 as pos from {table} where {c} <> ''"
    many = lambda rule, c, n: f"select country, {key}, {rule}, t, pos from (select country, {key}, unnest({c}) as t, unnest(range(0, len({c}))) as pos from {table}) where length(t) >= {n}"
    parts = [single(1, "n_compact"), many(2, "n_tokens", 3), single(3, "a_num_word"), single(4, "a_plot"), single(5, "a_postal"), many(6, "a_tokens", 4)]
    return f"{name} as ({' union all '.join(parts)})"


MATCHES = """
matches as (
  select k.q_row, p.cand_idx, k.rule, k.pos, case when len(q.n_tokens) <= 2 then 1 else 2 end as min_hits, c.country_first
  from qkeys k join queries q using (q_row) join capped p on k.rule = p.rule and k.key = p.key
    and (k.country = p.country or k.country not in (select country from countries))
  join countries c on p.country = c.country),
counted as (
  select q_row, cand_idx, max(min_hits) as min_hits, min(country_first) as country_first,
    count(*) filter (rule = 1) as h1, count(*) filter (rule = 2) as h2, count(*) filter (rule = 3) as h3,
    count(*) filter (rule = 4) as h4, count(*) filter (rule = 5) as h5, count(*) filter (rule = 6) as h6,
    min(pos) filter (rule = 2) as p2, min(pos) filter (rule = 6) as p6
  from matches group by q_row, cand_idx),
kept as (
  select *, h1 > 0 as k1, h2 >= min_hits as k2, h3 > 0 as k3, h4 > 0 as k4, h6 >= 2 as k6,
    h5 > 0 and (h1 > 0 or h2 >= min_hits or h3 > 0 or h4 > 0) as k5 from counted),
scored as (
  select q_row, cand_idx, country_first,
    ((case when k1 then 12 else 0 end) + (case when k2 then 5 * h2 else 0 end) + (case when k3 then 6 else 0 end)
      + (case when k4 then 6 else 0 end) + (case when k5 then 4 else 0 end) + (case when k6 then 4 * h6 else 0 end))::bigint as score,
    concat_ws(',', case when k6 then 'addr_tokens' end, case when k1 then 'compact_name' end, case when k3 then 'num_street' end,
      case when k4 then 'plot_num' end, case when k5 then 'postal' end, case when k2 then 'token_overlap' end) as reasons,
    case when k1 then 1 when k2 then 2 when k3 then 3 when k4 then 4 when k6 then 6 end as first_rule,
    case when k1 then 0 when k2 then p2 when k3 or k4 then 0 else p6 end as first_pos
  from kept where k1 or k2 or k3 or k4 or k6),
top as (
  select q_row, cand_idx, score, reasons, (row_number() over (partition by q_row order by score desc, country_first, first_rule, first_pos, cand_idx))::int as rank
  from scored qualify rank <= 15),
pairs as (
  select t.*, q.entity_id as s1_id, c.entity_id as cand_id from top t join queries q using (q_row) join pool c using (cand_idx))"""

_bare = lambda x: f"regexp_replace({x}, '\\s+', '', 'g')"


def _grams(x: str) -> str:
    b = _bare(x)
    return f"case when {b} = '' then [] else list_transform(range(1, greatest(length({b}) - 1, 2)), lambda i: substr({b}, i, 3)) end"


def _jaccard(a: str, b: str) -> str:
    return f"case when len({a}) = 0 or len({b}) = 0 then 0.0 else len(list_intersect({a}, {b}))::double / len(list_distinct(list_concat({a}, {b}))) end"


def _overlap(a: str, b: str) -> str:
    return f"case when len({a}) = 0 or len({b}) = 0 then 0.0 else len(list_intersect({a}, {b}))::double / least(len(list_distinct({a})), len(list_distinct({b}))) end"


def _ratio(a: str, b: str) -> str:
    n = lambda s, c: f"length({s}) - length(replace({s}, {c}, ''))"
    shared = f"coalesce(list_sum(list_transform(list_distinct(string_split({a}, '')), lambda c: case when c = '' then 0 else least({n(a, 'c')}, {n(b, 'c')}) end)), 0)"
    return f"case when {a} = '' or {b} = '' then 0.0 when {a} = {b} then 1.0 else 2.0::double * {shared} / (length({a}) + length({b})) end"


def _cosine(a: str, b: str) -> str:
    return (
        f"case when {a} = '' or {b} = '' then 0.0 when {a} = {b} then 1.0 when length({_bare(a)}) < 3 or length({_bare(b)}) < 3 then ({_bare(a)} = {_bare(b)})::int::double"
        f" else coalesce((select d from dots where dots.a = {a} and dots.b = {b}), 0) end"
    )


#: Cosines of the gram counts, by pair of texts.
DOTS = f"""
text_pairs as (select distinct l_n as a, r_n as b from sides union select distinct l_a, r_a from sides),
gram_counts as (
  select t, g, count(*) as n from (
    select t, unnest({_grams("t")}) as g from (select a as t from text_pairs union select b from text_pairs)) group by all),
norms as (select t, sqrt(sum(n * n)::double) as norm from gram_counts group by t),
dots as (
  select a, b, sum(x.n * y.n)::double / (any_value(na.norm) * any_value(nb.norm)) as d
  from text_pairs join gram_counts x on x.t = a join gram_counts y on y.t = b and x.g = y.g
  join norms na on na.t = a join norms nb on nb.t = b group by a, b)"""


SIDES = f"""
sides as (
  select p.*, l.n_text as l_n, r.n_text as r_n, l.n_tokens as l_t, r.n_tokens as r_t, l.n_compact as l_c, r.n_compact as r_c,
    l.a_text as l_a, r.a_text as r_a, l.a_tokens as l_at, r.a_tokens as r_at, l.a_postal as l_p, r.a_postal as r_p,
    l.a_num_word as l_w, r.a_num_word as r_w, {_grams("l.n_text")} as l_ng, {_grams("r.n_text")} as r_ng, {_grams("l.a_text")} as l_ag, {_grams("r.a_text")} as r_ag
  from pairs p join queries l using (q_row) join pool r using (cand_idx))"""

#: A score that needs no model: the mean of three similarities.
BLEND = f"""
blend as (
  select q_row, s1_id, cand_idx, cand_id, rank, round(({_jaccard("l_t", "r_t")}), 6) as prob_a,
    round(({_jaccard("l_ng", "r_ng")} + {_jaccard("l_at", "r_at")}) / 2.0, 6) as prob_b from sides)"""

TRUTH = """
truth as (
  select distinct l.entity_id as s1_id, r.entity_id as cand_id from raw l join raw r using (p_name, p_brand, country)
  where l.entity_id like 'S1-%' and r.entity_id not like 'S1-%'),
truth_n as (select s1_id, count(*) as n from truth group by s1_id)"""

FBETA = "case when n_true = 0 then (n_pred = 0)::int::double when n_pred = 0 or hits = 0 then 0.0 else 1.25 * (hits::double / n_pred) * (hits::double / n_true) / (0.25 * (hits::double / n_pred) + hits::double / n_true) end"

ACCEPTED = "accepted as (select *, round(0.5 * prob_a + 0.5 * prob_b, 6) as prob from blend where round(0.5 * prob_a + 0.5 * prob_b, 6) >= 0.6)"
SCORES = f"""
entity as (
  select i.s1_id, coalesce(t.n, 0)::bigint as n_true, coalesce(p.n, 0)::bigint as n_pred, coalesce(p.hits, 0)::bigint as hits
  from (select distinct entity_id as s1_id from queries) i left join truth_n t using (s1_id)
  left join (select a.s1_id, count(distinct a.cand_id) as n, count(distinct t.cand_id) as hits
    from accepted a left join truth t on a.s1_id = t.s1_id and a.cand_id = t.cand_id group by a.s1_id) p using (s1_id)),
entity_score as (select *, {FBETA} as score from entity)"""


def _with(*parts: str) -> str:
    return "with " + ",".join(parts)


def _grid(weights, final: str) -> str:
    doubles = lambda xs: f"{[repr(x) for x in xs]}::double[]"
    cells = f"(select unnest({doubles(weights)}) as weight), (select unnest({doubles(THRESHOLDS)}) as threshold)"
    return f"""{_with(base(), MATCHES, SIDES, BLEND, TRUTH)},
cells as (select * from {cells}),
ids as (select distinct s1_id from blend),
preds as (
  select c.weight, c.threshold, b.s1_id, count(distinct b.cand_id) as n_pred, count(distinct t.cand_id) as hits
  from cells c join blend b on c.weight * b.prob_a + (1.0::double - c.weight) * b.prob_b >= c.threshold
  left join truth t on b.s1_id = t.s1_id and b.cand_id = t.cand_id group by all),
filled as (
  select c.weight, c.threshold, i.s1_id, coalesce(t.n, 0) as n_true, coalesce(p.n_pred, 0) as n_pred, coalesce(p.hits, 0) as hits
  from cells c, ids i left join preds p on p.weight = c.weight and p.threshold = c.threshold and p.s1_id = i.s1_id
  left join truth_n t on t.s1_id = i.s1_id),
curve as (select weight, threshold, round(avg({FBETA}), 9) as macro_f05 from filled group by weight, threshold)
{final}"""


def _rule(number: int) -> str:
    least = {2: "having count(*) >= max(min_hits)", 6: "having count(*) >= 2"}.get(number, "")
    return f"{_with(base(), MATCHES)} select q_row, cand_idx, count(*) as hits from matches where rule = {number} group by q_row, cand_idx {least}"


def _features(columns: dict[str, str], *more: str) -> str:
    made = ", ".join(f"round({v}, 6) as {k}" for k, v in columns.items())
    return f"{_with(base(), MATCHES, SIDES, *more)} select q_row, cand_idx, {made} from sides"


_same = lambda a, b: f"({a} <> '' and {a} = {b})::int::double"
_gap = lambda a, b: f"abs(length({a}) - length({b}))::double / greatest(length({a}), length({b}), 1)"
_agree = lambda a, b: f"case when {a} = '' or {b} = '' then -1.0 else ({a} = {b})::int::double end"

DOC_TEXT = f"with t as (select doc_id as row_id, {clean('text')} as t from documents)"
_lists = lambda rows, column: f"select q.q_row, q.entity_id as source1_entity_id, coalesce(string_agg(p.cand_id, ',' order by p.rank), '') as {column} from queries q left join {rows} p using (q_row) group by q.q_row, q.entity_id"

VALIDATE = """
with rows as (
  select p_partkey as line, case p_partkey % 50 when 7 then 'S1-3' else 'S1-' || p_partkey end as s1, p_partkey % 40 = 9 as malformed,
    case p_partkey % 8 when 0 then [] when 1 then ['S2-' || p_partkey, 'S2-' || p_partkey] when 2 then ['S1-' || p_partkey] when 3 then ['X-' || (p_partkey % 9)]
      else ['S2-' || p_partkey, 'S3-' || p_partkey] end as ids from part),
cands as (select line, s1, case when line % 16 = 4 then ['S2-' || line] else ids end as ids from rows where not malformed),
good as (select * from rows where not malformed),
needed as (select 'S1-' || p_partkey as s1 from part where p_partkey % 5 <> 0),
lastm as (select s1, max_by(ids, line) as ids from good group by s1),
lastc as (select s1, max_by(ids, line) as ids from cands group by s1),
offenders as (
  select 'error' as severity, 'malformed_row' as finding, line::varchar as o from rows where malformed
  union all select 'error', 'duplicate_row', s1 from good group by s1 having count(*) > 1
  union all select 'error', 'repeated_id', s1 from good where len(ids) <> len(list_distinct(ids))
  union all select 'error', 'self_match', id from (select unnest(ids) as id from good) where id like 'S1-%'
  union all select 'error', 'wrong_prefix', id from (select unnest(ids) as id from good) where id not like 'S1-%' and id not like 'S2-%' and id not like 'S3-%'
  union all select 'error', 'missing_entity', s1 from needed where s1 not in (select s1 from good)
  union all select 'error', 'unexpected_entity', s1 from good where s1 not in (select s1 from needed)
  union all select 'warning', 'not_among_candidates', m.s1 from (select s1, unnest(ids) as id from lastm) m
    left join (select s1, unnest(ids) as id from lastc) c on m.s1 = c.s1 and m.id = c.id where c.id is null),
ranked as (select *, row_number() over (partition by severity, finding order by o) as r, count(*) over (partition by severity, finding) as n
  from (select distinct * from offenders))
select 'matching' as file, severity, finding, max(n)::bigint as n,
  case when max(n) > 5 then max(n) || ' total, e.g. ' || string_agg(o, ', ' order by o) filter (r <= 5) || ', ...' else string_agg(o, ', ' order by o) end as examples
from ranked group by severity, finding"""

RESULT_LINES = f"{_with(base(), MATCHES, SIDES, BLEND, ACCEPTED)}, matches_of as ({_lists('accepted', 'matched_entity_ids')}), candidates_of as ({_lists('pairs', 'candidate_entity_ids')})"

#: By pair of texts. A character of a takes the first free equal one of b within the window; a match is the
#: list element i * 2^20 + j, counted from 0.
JARO_WINKLER = """
jw_texts as (select distinct l_n as a, r_n as b from sides union select distinct l_a, r_a from sides),
jw_windows as (select a, b, greatest(length(a), length(b)) // 2 - 1 as reach from jw_texts where a <> '' and b <> '' and a <> b),
jw_matches as (
  select a, b, list_reduce(list_prepend([]::bigint[], list_transform(range(0, length(a)), lambda i: [i])), lambda taken, x:
    list_concat(taken, list_transform(list_filter(range(greatest(0, x[1] - reach), least(x[1] + reach + 1, length(b))), lambda j:
      substr(b, (j + 1)::int, 1) = substr(a, (x[1] + 1)::int, 1) and not list_contains(list_transform(taken, lambda t: t & 1048575), j))[1:1], lambda j: x[1] * 1048576 + j))) as m
  from jw_windows),
jw_parts as (
  select a, b, len(m)::double as n, list_transform(m, lambda t: substr(a, ((t >> 20) + 1)::int, 1)) as x,
    list_transform(list_sort(list_transform(m, lambda t: t & 1048575)), lambda j: substr(b, (j + 1)::int, 1)) as y,
    case when substr(a, 1, 1) <> substr(b, 1, 1) then 0 when substr(a, 1, 2) <> substr(b, 1, 2) or least(length(a), length(b)) < 2 then 1
      when substr(a, 1, 3) <> substr(b, 1, 3) or least(length(a), length(b)) < 3 then 2
      when substr(a, 1, 4) <> substr(b, 1, 4) or least(length(a), length(b)) < 4 then 3 else 4 end as prefix
  from jw_matches),
jw_jaro as (
  select a, b, prefix, case when n = 0 then 0.0 else
    (n / length(a) + n / length(b) + (n - len(list_filter(range(1, len(x) + 1), lambda i: x[i] <> y[i])) / 2.0::double) / n) / 3.0 end as j, n
  from jw_parts),
jw as (
  select a, b, case when n = 0 then 0.0 else j + prefix * 0.1::double * (1.0 - j) end as s from jw_jaro
  union all select a, b, case when a = '' or b = '' then 0.0 else 1.0 end from jw_texts where a = '' or b = '' or a = b)"""

_top_lists = _lists("pairs", "candidate_entity_ids")

ORACLE_SQL = {
    "q_unicode_clean": f"with raw as ({DOCUMENTS_SQL}) select row_id, {clean('business_name')} as name_clean, {clean('business_address')} as addr_clean, {clean('country')} as country_clean from raw",
    "q_name_tokens": f"with raw as ({DOCUMENTS_SQL}), w as (select row_id, {words(clean('business_name'))} as ws from raw) select row_id, array_to_string(ws, ' ') as n_text, array_to_string({core('ws')}, ' ') as n_tokens from w",
    "q_name_compact": f"{_with(base())} select row_id, n_compact from normal",
    "q_postal_extract": f"{_with(base())} select row_id, a_postal from normal",
    "q_num_word": f"{DOC_TEXT} select row_id, {street('t')} as a_num_word from t",
    "q_plot": f"{DOC_TEXT} select row_id, {plot('t')} as a_plot from t",
    "q_addr_tokens": f"{_with(base())} select row_id, array_to_string(a_tokens, ' ') as a_tokens from normal",
    "q_posting_stats": f"{_with(base())} select country, rule, count(*) as n_keys, sum(n)::bigint as n_postings, max(n)::bigint as longest from sizes group by country, rule",
    **{f"q_rule_{name}": _rule(n) for name, n in RULES.items()},
    "q_block_scores": f"{_with(base(), MATCHES)} select q_row, cand_idx, score, reasons, country_first, first_rule, first_pos from scored",
    "q_top15_candidates": f"{_with(base(), MATCHES)} select q_row, s1_id, cand_idx, cand_id, rank, score, reasons from pairs",
    "q_reasons": f"{_with(base(), MATCHES)} select reasons, count(*) as n from top group by reasons",
    "q_unknown_country": f"{_with(base(foreign=True), MATCHES)} select q_row, cand_idx, rank, score, reasons from top",
    "q_candidate_lists": f"{_with(base(), MATCHES)} {_top_lists}",
    "q_stream_candidates": f"{_with(base(), MATCHES)} {_top_lists}",
    "q_match_lists": f"{_with(base(), MATCHES, SIDES, BLEND, ACCEPTED)} {_lists('accepted', 'matched_entity_ids')}",
    "q_feat_exact_len": _features({"name_exact": _same("l_n", "r_n"), "name_compact_match": _same("l_c", "r_c"), "name_len_diff_ratio": _gap("l_n", "r_n"), "addr_exact": _same("l_a", "r_a"), "addr_len_diff_ratio": _gap("l_a", "r_a")}),
    "q_feat_jaccard_overlap": _features({"name_token_jaccard": _jaccard("l_t", "r_t"), "name_token_overlap_cnt": "len(list_intersect(l_t, r_t))::double", "name_overlap_coeff": _overlap("l_t", "r_t"), "addr_token_jaccard": _jaccard("l_at", "r_at"), "addr_overlap_coeff": _overlap("l_at", "r_at")}),
    "q_feat_3gram_jaccard": _features({"name_char3_jaccard": _jaccard("l_ng", "r_ng"), "addr_char3_jaccard": _jaccard("l_ag", "r_ag")}),
    "q_feat_quick_ratio": _features({"name_seq_ratio": _ratio("l_n", "r_n"), "addr_seq_ratio": _ratio("l_a", "r_a")}),
    "q_feat_cosine": _features({"name_char3_cosine": _cosine("l_n", "r_n"), "addr_char3_cosine": _cosine("l_a", "r_a")}, DOTS),
    "q_feat_structured": _features({"postal_match": _agree("l_p", "r_p"), "num_word_match": _agree("l_w", "r_w")}),
    "q_feat_reason_flags": _features({"blocking_score": "len(string_split(reasons, ','))::double", **{f"reason_{r}": f"list_contains(string_split(reasons, ','), '{r}')::int::double" for r in RULES}}),
    "q_recall_ceiling": f"{_with(base(), MATCHES, TRUTH)} select (select count(*) from pairs p semi join truth t using (s1_id, cand_id)) as retrieved, (select count(*) from truth) as total_positives, round((select count(*) from pairs p semi join truth t using (s1_id, cand_id))::double / (select count(*) from truth), 9) as recall",
    "q_class_balance": f"{_with(base(), MATCHES, TRUTH)}, l as (select (t.s1_id is not null) as m from pairs p left join truth t using (s1_id, cand_id)) select count(*) filter (m) as positives, count(*) filter (not m) as negatives, round(greatest(count(*) filter (not m), 1)::double / greatest(count(*) filter (m), 1), 9) as scale_pos_weight from l",
    "q_entity_fbeta": f"{_with(base(), MATCHES, SIDES, BLEND, ACCEPTED, TRUTH, SCORES)} select s1_id, n_true, n_pred, hits, round(score, 9) as score from entity_score",
    "q_macro_fbeta": f"{_with(base(), MATCHES, SIDES, BLEND, ACCEPTED, TRUTH, SCORES)} select round(avg(score), 9) as macro_f05, count(*) as total_entities, count(*) filter (n_true = 0) as singleton_total, count(*) filter (n_true = 0 and n_pred = 0) as singleton_correct, round(coalesce(count(*) filter (n_true = 0 and n_pred = 0)::double / nullif(count(*) filter (n_true = 0), 0), 1.0), 9) as singleton_acc from entity_score",
    "q_threshold_curve": _grid([1.0], "select round(threshold, 6) as threshold, macro_f05 from curve"),
    "q_blend_grid": _grid(WEIGHTS, "select round(weight, 6) as weight, round(threshold, 6) as threshold, macro_f05 from curve"),
    "q_pool_quota": f"{_with(base(), TRUTH)}, n as (select *, row_number() over (order by row_id) as i from raw where entity_id like 'S2-%') select row_id, entity_id from n where i <= 50 or entity_id in (select cand_id from truth)",
    "q_truth_last_wins": "select 'S1-' || o_custkey as s1_id, array_to_string(max_by(['S2-' || o_orderkey, 'S3-' || o_orderkey], o_orderkey), ',') as matches from orders where o_custkey in (select c_custkey from customer where c_mktsegment = 'BUILDING') group by o_custkey",
    "q_countries": f"{_with(base())} select country, count(*) as n_entities, min(cand_idx) as country_first from pool group by country",
    "q_grid_best": _grid(WEIGHTS, "select round(weight, 6) as weight, round(threshold, 6) as threshold, macro_f05 from curve order by curve.macro_f05 desc, curve.weight, curve.threshold limit 1"),
    "q_group_split": f"""{_with(base(), MATCHES)}, keys as (select distinct s1_id from pairs),
placed as (select s1_id, row_number() over (order by md5('{SEED}:' || s1_id), s1_id) as i, count(*) over () as n from keys)
select s1_id, i <= ceil(n * {VALIDATION_SHARE}) as is_val from placed""",
    "q_result_lines": RESULT_LINES + """ select 'matching' as file, (row_number() over (order by q_row))::int as place, source1_entity_id as s1, matched_entity_ids as ids from matches_of
union all select 'candidates', (row_number() over (order by q_row))::int, source1_entity_id, candidate_entity_ids from candidates_of""",
    "q_result_counters": RESULT_LINES + """ select 'matching' as file, count(*) as n_rows, count(*) filter (matched_entity_ids = '') as n_empty, count(*) filter (matched_entity_ids <> '') as n_filled, 0::bigint as findings from matches_of
union all select 'candidates', count(*), count(*) filter (candidate_entity_ids = ''), count(*) filter (candidate_entity_ids <> ''), 0 from candidates_of""",
    "q_header_checks": """
with h as (select n_nationkey::bigint as n_nationkey, case n_nationkey % 5 when 0 then 'source1_entity_id' || chr(9) || 'matched_entity_ids'
    when 1 then ' Source1_Entity_ID ' || chr(9) || (case when n_nationkey % 2 = 0 then 'MATCHED_ENTITY_IDS' else n_name end)
    when 2 then 'source1_entity_id,' || n_name when 3 then '' else n_name end as header from nation)
select n_nationkey, header, case when header = '' then 'empty_file' when not contains(header, chr(9)) and contains(header, ',') then 'comma_separated'
  when list_transform(string_split(header, chr(9)), lambda c: lower(trim(c))) <> ['source1_entity_id', 'matched_entity_ids'] then 'unexpected_header' end as problem from h""",
    "q_feat_jaro_winkler": _features({"name_jaro_winkler": "(select s from jw where jw.a = l_n and jw.b = r_n)", "addr_jaro_winkler": "(select s from jw where jw.a = l_a and jw.b = r_a)"}, JARO_WINKLER),
    "q_validate_report": VALIDATE,
    "q_link_totals": f"{_with(base(), MATCHES, SIDES, BLEND, ACCEPTED)}, lists as ({_lists('accepted', 'matched_entity_ids')}) select count(*) as processed, count(*) filter (matched_entity_ids <> '') as matched, count(*) filter (matched_entity_ids = '') as singletons from lists",
}
