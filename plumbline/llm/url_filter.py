"""URL filters: pattern rules indexed by their rarest literal token, in DataFrame functions only.

A rule has a regular expression and literal tokens that each url it matches must hold. The tokens are
counted over all urls, each rule is filed under its rarest one, and a url's tokens fetch the rules to try;
only those run their regular expression. Domain rules (host and path) are compiled to such patterns
too; the longest that matches wins, and only a url without one is judged by the pattern rules.

Each distinct url is judged once, so a hot url costs one row; its pages take the verdict by a join
that AQE splits. Pages without a url take no part in it. Rules are given with the code: their index is broadcast within
a checked bound, and each pattern is a literal, compiled once for a task.

Defined cases: null urls and urls without "://" have empty host and path, no rule, and are allowed; an
empty url list gives no rows; repeated rows give equal rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import look_up
from plumbline.sources.shared import cut


class Rule(NamedTuple):
    """name; block or allow; pattern over "host#path" (neither part can hold a #); tokens that a match must hold; rank (higher wins)."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int


#: The domain rules, as (verdict, rule).
DOMAIN_RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Pattern rules for urls that no domain rule fits: (name, literal tokens, pattern over host#path).
PATTERN_RULES = (
    ("spam host", ("spam",), r"(^|[.-])spam([.-][^#]*)?#"),
    ("pills host", ("pills",), r"(^|[.-])(cheap|buy|online)-pills\.[^#]*#"),
    ("casino host", ("casino",), r"(^|[.-])casino([.-][^#]*)?#"),
    ("adult host", ("xxx",), r"(^|[.-])xxx([.-][^#]*)?#"),
    ("tracker path", ("track", "click"), r"#(/[^/#]*)*/track/click(/|$)"),
    ("ad server path", ("adserver",), r"#(/[^/#]*)*/adserver(/|$)"),
)


def _tokens(text: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(t for t in re.split(r"[^a-z0-9]+", text.lower()) if t))


def domain_rule(verdict: str, rule: str) -> Rule:
    """A rule host + path as a pattern: the host itself or a subdomain, and a path that starts with the rule's."""
    host, slash, path = rule.partition("/")
    # A path may end inside a longer token, so its last token is no literal to search by.
    held = _tokens(host) + (_tokens(path.rpartition("/")[0]) if path else ())
    return Rule(rule, verdict, rf"^(?:[^#]*\.)?{re.escape(host)}#{re.escape(slash + path)}", held, 1_000_000 + len(rule))


def default_rules() -> list[Rule]:
    return [domain_rule(*r) for r in DOMAIN_RULES] + [Rule(name, "block", pattern, tokens, len(PATTERN_RULES) - i) for i, (name, tokens, pattern) in enumerate(PATTERN_RULES)]


def url_parts(urls: DataFrame) -> DataFrame:
    """urls (url) with host and path."""
    rest = F.when(F.instr("url", "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return urls.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit("")))


def _matches(rules: list[Rule]) -> Column:
    """Whether the rule of the row's id matches its host and path."""
    at = F.concat("host", F.lit("#"), "path")
    out = F.when(F.lit(False), False)
    for i, r in enumerate(rules):
        out = out.when(F.col("id") == i, at.rlike(r.pattern))
    return out


def judge_urls(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """Distinct non-null urls with host, path, rule, verdict ("allow" where nothing matches)."""
    spark = urls.sparkSession
    known = url_parts(urls.select("url").where("url is not null").distinct())
    known = cut(known.withColumn("tokens", F.array_distinct(F.filter(F.split(F.lower(F.concat_ws("#", "host", "path")), "[^a-z0-9]+"), lambda t: t != ""))))
    table = spark.createDataFrame([(i, r.name, r.verdict, r.rank) for i, r in enumerate(rules)], "id int, name string, verdict string, rank int")
    literals = spark.createDataFrame([(i, t) for i, r in enumerate(rules) for t in r.tokens], "id int, token string")
    seen = known.select(F.explode("tokens").alias("token"))
    counts = look_up(seen, literals.select("token").distinct(), ["token"], "left_semi").groupBy("token").count()
    filed = literals.join(counts, "token", "left").withColumn("n", F.row_number().over(Window.partitionBy("id").orderBy(F.coalesce("count", F.lit(0)), "token"))).filter("n = 1")
    index = cut(filed.select("token", "id").join(table, "id"))
    tried = look_up(known.withColumn("token", F.explode("tokens")).drop("tokens"), index, ["token"], "inner")
    matched = tried.filter(_matches(rules)).groupBy("url").agg(F.max(F.struct("rank", F.col("id"), "name", "verdict")).alias("best"))
    return known.drop("tokens").join(matched, "url", "left").select("url", "host", "path", F.when(F.col("best.rank") >= 1_000_000, F.col("best.name")).alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict"), F.when(F.col("best.rank") < 1_000_000, F.col("best.name")).alias("pattern"))


def filter_urls(pages: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row for each page: page_id, host, path, rule (a domain rule or null), verdict, pattern (the pattern rule that decided, or null)."""
    known = pages.filter("url is not null").select("page_id", "url")
    judged = known.join(judge_urls(known, default_rules() if rules is None else rules), "url").select("page_id", "host", "path", "rule", "verdict", "pattern")
    none = F.lit(None).cast("string")
    return judged.unionByName(pages.filter("url is null").select("page_id", F.lit("").alias("host"), F.lit("").alias("path"), none.alias("rule"), F.lit("allow").alias("verdict"), none.alias("pattern")))
