"""URL filters: pattern rules indexed by their rarest literal token, in SQL functions only.

A rule is a regular expression with the literal tokens (runs of letters and digits, set off on both
sides) that every match must contain. The tokens of all rules are counted over all URLs in one
aggregate, and each rule is filed under the token that the fewest URLs hold. A URL's tokens fetch its
candidate rules; only those run their expressions. Rules come as a table of any size (see
:func:`rules_frame` and :func:`read_rules`).

An index whose rows and bytes, both counted, are few is one constant: an array of buckets by token hash,
in which a token finds its rules in constant time, and no row is shuffled. A larger one is joined: the
URLs' distinct tokens meet the filed rules, and what is left after the expressions is grouped by URL.

Site rules (host, path) fit a host and its subdomains where the path begins with theirs; the longest
wins. They are pattern rules as well, in front of the general ones. A URL that no site rule fits is
blocked if a general rule matches, and allowed otherwise.

Scale: two passes over the url column (token counts, then verdicts), no Python. With the constant index
there is no join of the pages and no shuffle but of the pre-aggregated token counts; with the joined one
only (row number, token) pairs and hits are shuffled, and Spark splits hot tokens.

Defined cases: null or text without ``://``: host and path empty, no rule, general rules still look
at the text (null: allowed); very long URLs are tokenized and matched whole; ties among site rules of one
length go to the label that sorts last; repeated rows come back repeated; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SMALL_BYTES, SMALL_ROWS, cut_lineage, small_or_shuffled

ALLOW, BLOCK = "allow", "block"
RULES = "array<struct<tokens:array<string>,pattern:string,verdict:string,label:string,site:boolean>>"
#: A filed rule, as it lies in the index.
ENTRY = "struct<token:string,pattern:string,verdict:string,label:string,site:boolean>"

# The site rules (verdict, host, path).
SITE_RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)

#: General rules: what a match must contain, and the pattern over the URL in lower case.
GENERAL_RULES = (
    (("casino",), r"[./?&=_-]casino([./?&=_-]|$)"),
    (("poker", "bonus"), r"[./]poker[./].*[/?&=_-]bonus([/?&=_-]|$)"),
    (("viagra",), r"[./?&=_-]viagra([./?&=_-]|$)"),
    (("payday", "loans"), r"[./-]payday-loans([./?&=_-]|$)"),
    (("porn",), r"[./?&=_-]porn([./?&=_-]|$)"),
    (("xxx",), r"[./]xxx([./?&]|$)"),
    (("torrent",), r"[./]torrent([./?&=_-]|$)"),
    (("warez",), r"[./?&=_-]warez([./?&=_-]|$)"),
    (("doubleclick",), r"//([^/?#]*\.)?doubleclick\.[a-z]+([/?#:]|$)"),
    (("adserver",), r"[./]adserver([./?&=_-]|$)"),
    (("wp", "login", "php"), r"/wp-login\.php([?#]|$)"),
    (("phpsessid",), r"[?&;]phpsessid="),
    (("sessionid",), r"[?&;]sessionid="),
    (("cart", "checkout"), r"/cart/checkout([/?#]|$)"),
    (("account", "login"), r"/account/login([/?#]|$)"),
    (("add", "to", "cart"), r"[?&]add-to-cart="),
    (("exe",), r"^[^?#]*\.exe([?#]|$)"),
    (("apk",), r"^[^?#]*\.apk([?#]|$)"),
    (("zip",), r"^[^?#]*\.zip([?#]|$)"),
    (("dmg",), r"^[^?#]*\.dmg([?#]|$)"),
)


@dataclass(frozen=True)
class Rule:
    tokens: tuple[str, ...]
    pattern: str
    verdict: str
    label: str
    site: bool


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", text)


def _lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def site_rule(verdict: str, host: str, path: str) -> Rule:
    # A run of letters and digits at the end of the path may go on in a URL: it is no whole token.
    tokens = re.findall(r"[a-z0-9]+", host) + re.findall(r"[a-z0-9]+(?=[^a-z0-9])", path.lower())
    return Rule(tuple(tokens), rf"^(?:[^/]*\.)?{_quoted(host)}{_quoted(path)}", verdict, host + path, True)


def default_rules() -> list[Rule]:
    sites = [site_rule(*r) for r in SITE_RULES]
    return sites + [Rule(tokens, pattern, BLOCK, pattern, False) for tokens, pattern in GENERAL_RULES]


def host_of(url: Column) -> Column:
    return _lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """Distinct runs of letters and digits, in lower case."""
    return F.array_distinct(F.split(_lower(F.coalesce(url, F.lit(""))), "[^a-z0-9]+"))


def rules_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """The rules as a table."""
    rows = json.dumps([asdict(r) for r in rules])
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows), RULES)))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """General rules of a text file: lines of verdict, tokens (comma-joined) and pattern, tab-separated."""
    f = F.split("value", "\t", 3)
    rows = spark.read.text(path).filter(F.size(f) == 3)
    part = lambda i: F.get(f, F.lit(i))
    tokens = F.filter(F.split(_lower(part(1)), ","), lambda t: t != "")
    return rows.select(tokens.alias("tokens"), part(2).alias("pattern"), F.trim(part(0)).alias("verdict"), part(2).alias("label"), F.lit(False).alias("site"))


def file_rules(pages: DataFrame, rules: DataFrame, url_col: str = "url") -> DataFrame:
    """``token, pattern, verdict, label, site``: each rule under that of its tokens which the fewest URLs
    hold (then the longest, then the first)."""
    rules = rules.withColumn("n", F.monotonically_increasing_id())
    needed = cut_lineage(rules.select(F.explode("tokens").alias("token")).distinct())
    tokens = pages.select(F.explode(tokens_of(F.col(url_col))).alias("token"))
    counts = tokens.join(small_or_shuffled(needed), "token", "left_semi").groupBy("token").agg(F.count("*").alias("urls"))
    of = rules.select("n", F.explode("tokens").alias("token")).join(counts, "token", "left")
    order = F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), -F.length("token"), F.col("token"))
    rarest = of.groupBy("n").agg(F.min_by("token", order).alias("token"))
    return rules.join(rarest, "n").select("token", "pattern", "verdict", "label", "site")


def _matches(e: Column, site: Column, low: Column) -> Column:
    return F.rlike(F.when(e["site"], site).otherwise(low), e["pattern"])


def _by_constant(rows: DataFrame, filed: DataFrame) -> DataFrame:
    """``rows`` with ``_hits``: the rules that match, out of one constant array of buckets."""
    size = 1 << (2 * filed.count()).bit_length()
    slot = lambda t: F.pmod(F.xxhash64(t), F.lit(size)).cast("int")
    # Spark's own hash decides the bucket here as well as for a URL's token.
    buckets: list[list[dict]] = [[] for _ in range(size)]
    for r in filed.withColumn("slot", slot(F.col("token"))).collect():
        e = r.asDict()
        buckets[e.pop("slot")].append(e)
    index = F.from_json(F.lit(json.dumps(buckets)), f"array<array<{ENTRY}>>")
    fetched = F.flatten(F.transform("_tokens", lambda t: F.filter(F.element_at(index, slot(t) + 1), lambda e: e["token"] == t)))
    return rows.withColumn("_hits", F.filter(fetched, lambda e: _matches(e, F.col("_site"), F.col("_low"))))


def _by_join(rows: DataFrame, filed: DataFrame) -> DataFrame:
    """``rows`` with ``_hits``, by a join of the URLs' tokens with the filed rules."""
    rows = cut_lineage(rows.withColumn("_n", F.monotonically_increasing_id()))
    pairs = rows.select("_n", "_site", "_low", F.explode("_tokens").alias("token"))
    hits = pairs.join(filed, "token").filter(_matches({c: F.col(c) for c in ("site", "pattern")}, F.col("_site"), F.col("_low")))
    entry = F.struct("token", "pattern", "verdict", "label", "site")
    # Of a URL's hits all are kept that can decide: the longest site rule, and whether a general one blocks.
    general = ~F.col("site") & (F.col("verdict") == BLOCK)
    best = F.max_by(F.when(F.col("site"), entry), F.when(F.col("site"), F.struct(F.length("label"), "label")))
    found = hits.groupBy("_n").agg(F.array_compact(F.array(best, F.max_by(F.when(general, entry), general))).alias("_hits"))
    joined = rows.join(found, "_n", "left")
    return joined.withColumn("_hits", F.coalesce("_hits", F.array().cast(f"array<{ENTRY}>")))


def judge(pages: DataFrame, keep: list[str], url_col: str = "url", rules: DataFrame | None = None, most_rows: int = SMALL_ROWS, most_bytes: int = SMALL_BYTES) -> DataFrame:
    """The columns in ``keep`` of every row, host, path, rule, verdict. An index of more than ``most_rows``
    or ``most_bytes`` is joined."""
    rules = rules_frame(pages.sparkSession, default_rules()) if rules is None else rules
    if not rules.filter(F.coalesce(F.size("tokens"), F.lit(0)) <= 0).isEmpty():
        raise ValueError("a rule without a literal token can't be indexed")
    filed = cut_lineage(file_rules(pages, rules, url_col))
    texts = [F.coalesce(F.length(F.col(c).cast("binary")), F.lit(0)) for c in ("token", "pattern", "verdict", "label")]
    n, size = filed.agg(F.count("*"), F.coalesce(F.sum(sum(texts[1:], texts[0])), F.lit(0))).first()
    url = F.col("_url")
    rows = pages.select(F.struct(*keep).alias("_kept"), F.col(url_col).alias("_url"))
    rows = rows.withColumns({"host": host_of(url), "path": path_of(url)})
    rows = rows.withColumns({"_tokens": tokens_of(url), "_site": F.concat("host", "path"), "_low": _lower(F.coalesce(url, F.lit("")))})
    rows = (_by_constant if n <= most_rows and size <= most_bytes else _by_join)(rows, filed)
    longest = F.array_max(F.transform(F.filter("_hits", lambda e: e["site"]), lambda e: F.struct(F.length(e["label"]), e["label"].alias("label"), e["verdict"].alias("verdict"))))
    general = F.exists("_hits", lambda e: ~e["site"] & (e["verdict"] == BLOCK))
    rows = rows.withColumn("_best", longest)
    verdict = F.coalesce(F.col("_best.verdict"), F.when(general, BLOCK).otherwise(ALLOW))
    return rows.select("_kept.*", "host", "path", F.col("_best.label").alias("rule"), verdict.alias("verdict"))


def _oracle_sql() -> str:
    ranked = sorted(SITE_RULES, key=lambda r: -len(r[1] + r[2]))
    fits = lambda h, p: f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')"
    rule = " ".join(f"when {fits(h, p)} then '{h}{p}'" for _, h, p in ranked)
    verdict = " ".join(f"when rule = '{h}{p}' then '{v}'" for v, h, p in ranked)
    general = " or ".join(f"regexp_matches(low, '{p}')" for _, p in GENERAL_RULES)
    lower = lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
with cut as (
  select page_id, {lower("coalesce(url, '')")} as low,
    {lower("regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1)")} as host,
    regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path from pages),
ruled as (select *, case {rule} end as rule from cut)
select page_id, host, path, rule, case {verdict} when {general} then 'block' else 'allow' end as verdict
from ruled"""


ORACLE_SQL = _oracle_sql()
