"""URL filters: host and path prefixes, then pattern rules found through their rarest literal tokens.

Built-in functions only. A pattern rule names the literal tokens every URL it matches must hold, or sets of tokens of
which it must hold one; it is filed under every token of the set that the corpus has least. A URL's tokens look that
index up by hash, and only the rules they fetch run their regular expression on it, and so do the rules that no whole
token stands for. The index is a constant of the plan, so its size is checked.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirelens.llm.common import LOWER, UPPER, query, table

MOST_RULES = 20_000


@dataclass(frozen=True)
class PrefixRule:
    """Fits its host and all subdomains where the path starts with ``path``; the longest fitting rule wins."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """A regular expression over the lower-cased URL; ``literals`` are whole tokens that any match holds.

    Where a match may hold one or another, they stand together as a tuple with every alternative. A rule without
    literals is tried on every URL.
    """

    name: str
    pattern: str
    literals: tuple[str | tuple[str, ...], ...]
    verdict: str = "block"

    def __post_init__(self):
        for tokens in self.token_sets:
            if not tokens or not all(re.fullmatch("[a-z]+|[0-9]+", t) for t in tokens):
                raise ValueError(f"{self.name}: {tokens} is no set of whole tokens, so no URL could fetch the rule by it")

    @property
    def token_sets(self) -> list[tuple[str, ...]]:
        return [(x,) if isinstance(x, str) else tuple(x) for x in self.literals]


PREFIX_RULES = (
    PrefixRule("net", "/", "block"),
    PrefixRule("example.net", "/en/", "allow"),
    PrefixRule("example.com", "/de/", "block"),
    PrefixRule("org", "/fr/", "allow"),
)

PATTERN_RULES = (
    PatternRule("spam-farm", r"://([a-z0-9-]+\.)*spam-farm\.", ("spam", "farm")),
    PatternRule("cheap-pills", r"://([a-z0-9-]+\.)*cheap-pills\.", ("cheap", "pills")),
    PatternRule("online-casino", r"[/.-](online|free|best)-casino[/.-]", (("online", "free", "best"), "casino")),
    PatternRule("adult-videos", r"[/.-](adult|porn|xxx)-videos?[/.-]", (("adult", "porn", "xxx"), ("video", "videos"))),
    PatternRule("warez", r"[/.-]warez[/.-]", ("warez",)),
    PatternRule("ad-server", r"://ads?[0-9]*\.", (("ad", "ads"),)),
    PatternRule(
        "click-redirect", r"[/?&](click|redirect|out)\.(php|cgi)\?url=", (("click", "redirect", "out"), ("php", "cgi"), "url"),
    ),
    PatternRule("session-id", r"[?&;](jsessionid|phpsessid|sessionid)=", (("jsessionid", "phpsessid", "sessionid"),)),
    PatternRule("login-form", r"/(login|signin|register)(\.[a-z]+)?([?#]|$)", (("login", "signin", "register"),)),
    PatternRule("about-casino", r"/help/(addiction|self-exclusion)/.*casino", ("help", ("addiction", "exclusion")), "allow"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def url_tokens(url: Column) -> Column:
    """Distinct runs of letters, and runs of digits, of the lower-cased URL."""
    return F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER), F.lit("[a-z]+|[0-9]+"), F.lit(0)))


def prefix_rule(host: Column, path: Column, rules: tuple[PrefixRule, ...]) -> Column:
    """The longest fitting rule's (name, verdict), else null."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def token_counts(pages: DataFrame, tokens: set[str]) -> dict[str, int]:
    """How many URLs hold each of the given tokens: at most one row a token, counted before the shuffle."""
    known = F.array(*[F.lit(t) for t in sorted(tokens)])
    found = pages.select(F.explode(F.array_intersect(url_tokens(F.col("url")), known)).alias("token"))
    counted = {r.token: r.n for r in found.groupBy("token").agg(F.count("*").alias("n")).collect()}
    return {t: counted.get(t, 0) for t in tokens}


def fetch_rules(tokens: Column, rules: tuple[PatternRule, ...], counts: dict[str, int]) -> Column:
    """The rules filed under one of a URL's tokens, each once, and those without literals.

    One look at a slot of a hash table for each token.
    """
    filed: list[tuple[str, PatternRule]] = []
    always: list[PatternRule] = []
    for rule in rules:
        if rule.token_sets:
            rarest = min(rule.token_sets, key=lambda ts: (sum(counts.get(t, 0) for t in set(ts)), ts))
            filed += [(t, rule) for t in sorted(set(rarest))]
        else:
            always.append(rule)
    if len(filed) + len(always) > MOST_RULES:
        raise ValueError(f"{len(filed) + len(always)} entries of pattern rules; the index in the plan is made for at most {MOST_RULES}")
    size = 1 << (2 * len(filed)).bit_length()
    slots: list[list[Column]] = [[] for _ in range(size)]
    for token, rule in filed:
        slots[zlib.crc32(token.encode()) % size].append(F.struct(F.lit(token).alias("token"), _as_struct(rule).alias("rule")))
    kind = "array<struct<token:string,rule:struct<name:string,pattern:string,verdict:string>>>"
    index = F.array(*[F.array(*slot).cast(kind) for slot in slots])
    fetched = F.flatten(F.transform(tokens, lambda t: F.transform(
        F.filter(F.element_at(index, (F.crc32(t) % size + 1).cast("int")), lambda e: e["token"] == t), lambda e: e["rule"]
    )))
    unfiled = F.array(*[_as_struct(r) for r in always]).cast("array<struct<name:string,pattern:string,verdict:string>>")
    return F.array_distinct(F.concat(unfiled, fetched))


def _as_struct(rule: PatternRule) -> Column:
    return F.struct(F.lit(rule.name).alias("name"), F.lit(rule.pattern).alias("pattern"), F.lit(rule.verdict).alias("verdict"))


def judge_urls(
    pages: DataFrame,
    prefixes: tuple[PrefixRule, ...] = PREFIX_RULES,
    patterns: tuple[PatternRule, ...] = PATTERN_RULES,
) -> DataFrame:
    """Each row's host, path, rule, verdict, and the pattern rules that matched.

    A prefix rule's verdict stands. Without one, an allowing pattern beats a blocking one, and no match allows.
    Null and empty URLs have an empty host and path and are allowed. Rows are judged one by one: repeated rows and
    repeated ids give as many rows, an empty table none. Further columns, also of the names made here, are ignored;
    only ``page_id`` and ``url`` are read.
    """
    pages = pages.select("page_id", "url")
    counts = token_counts(pages, {t for r in patterns for ts in r.token_sets for t in ts})
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"), url_tokens(F.col("url")).alias("tokens"))
    lower = F.translate(F.col("url"), UPPER, LOWER)
    matched = F.filter(fetch_rules(F.col("tokens"), patterns, counts), lambda r: F.rlike(lower, r["pattern"]))
    rows = rows.withColumn("matched", matched).withColumn("base", prefix_rule(F.col("host"), F.col("path"), prefixes))
    allowed = F.exists("matched", lambda r: r["verdict"] == "allow")
    blocked = F.exists("matched", lambda r: r["verdict"] == "block")
    return rows.select(
        "page_id", "host", "path", F.col("base.name").alias("rule"),
        F.coalesce(F.col("base.verdict"), F.when(blocked & ~allowed, "block").otherwise("allow")).alias("verdict"),
        F.array_join(F.array_sort(F.transform("matched", lambda r: r["name"])), ",").alias("patterns"),
    )


def _hits(verdict: str | None = None) -> str:
    """SQL for the names of the matching pattern rules."""
    cases = ", ".join(
        f"CASE WHEN regexp_matches(lower_url, '{r.pattern}') THEN '{r.name}' END"
        for r in sorted(PATTERN_RULES, key=lambda r: r.name) if verdict in (None, r.verdict)
    )
    return f"list_filter([{cases}], lambda x: x IS NOT NULL)"


def _fits(r: PrefixRule) -> str:
    return f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"


_LONGEST_FIRST = sorted(PREFIX_RULES, key=lambda r: (-len(r.name), r.name))
SQL = f"""
WITH rests AS (
  SELECT page_id, translate(url, '{UPPER}', '{LOWER}') AS lower_url,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, lower_url, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rests
), ruled AS (
  SELECT *, CASE {" ".join(f"{_fits(r)} THEN '{r.name}'" for r in _LONGEST_FIRST)} END AS rule,
    CASE {" ".join(f"{_fits(r)} THEN '{r.verdict}'" for r in _LONGEST_FIRST)} END AS verdict
  FROM parts
)
SELECT page_id, host, path, rule,
  CASE WHEN verdict IS NOT NULL THEN verdict
    WHEN lower_url IS NOT NULL AND len({_hits("block")}) > 0 AND len({_hits("allow")}) = 0 THEN 'block'
    ELSE 'allow' END AS verdict,
  coalesce(array_to_string({_hits()}, ','), '') AS patterns
FROM ruled
"""


@query("op10_url_rules", SQL)
def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL under the fixed prefix rules and the pattern rules."""
    return judge_urls(table(spark, sf_dir, "pages"))
