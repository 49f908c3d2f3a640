"""URL rules indexed by their rarest literal token.

A rule has a host and a path: it fits its host and all subdomains where the url's path starts with the rule's path.  Each rule
is filed under one literal token that every url it fits must contain: of the rule's tokens, the one that the fewest urls
have.  The tokens of a url fetch the candidate rules, and only those run their regular expression; the longest fitting rule wins
(of equally long ones, the smallest rule text).  Everything is DataFrame code.

Urls are judged once per distinct (host, path).  The rule index is broadcast up to ``BROADCAST_ROWS`` rules and joined by
shuffling beyond.

Defined cases: a null url, or one without ``://``, has an empty host and path and fits only a rule with an empty host and
path; no fitting rule gives the default verdict and a null rule; an empty table gives an empty table; repeated rows are judged
alike; other columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.frames import ascii_lower, checked_broadcast, col
from tidegrid.session import stage

BOUNDARY = r"[./]"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


#: fixed values: the rules that the registered query applies
RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(rest)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def literal_tokens(rule: Rule) -> list[str]:
    """Tokens that stand between boundaries in every url the rule fits.

    The last piece of the path is none unless the rule's path ends at a boundary: ``/de`` also fits ``/deep``.
    """
    host = [t for t in rule.host.split(".") if t]
    path = [t for t in re.split(BOUNDARY, rule.path)[:-1] if t]
    return sorted(set(host + path))


def pattern(rule: Rule) -> str:
    """Of hosts, which may hold any character but ``/?#``; an empty host fits every host."""
    return rf"(?s)^(?:.*\.)?{re.escape(rule.host)}\z" if rule.host else ""


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct tokens of a url; every url also has the empty token, which holds the rules without a literal."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(host, BOUNDARY), F.split(path, BOUNDARY)))


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rules as a table; their number is bounded by the list in the driver."""
    rows = [
        F.struct(
            F.lit(r.host + r.path).alias("rule"),
            F.lit(r.verdict).alias("verdict"),
            F.lit(pattern(r)).alias("pattern"),
            F.lit(r.path).alias("rule_path"),
            F.array(*[F.lit(t) for t in literal_tokens(r) or [""]]).alias("tokens"),
        )
        for r in rules
    ]
    empty = "array<struct<rule:string,verdict:string,pattern:string,rule_path:string,tokens:array<string>>>"
    return spark.range(1).select(F.inline(F.array(*rows) if rows else F.array().cast(empty)))


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``; ``rules`` as made by ``rule_table``."""
    located = pages.select(col(id_col).alias("page_id"), host_of(col(url_col)).alias("host"), path_of(col(url_col)).alias("path"))
    # one row per (host, path), told apart by a number drawn once
    places = stage(located.select("host", "path").distinct().withColumn("place", F.monotonically_increasing_id()), "url-places")
    tokens = places.select("place", F.explode(url_tokens(F.col("host"), F.col("path"))).alias("token"))

    wanted = rules.select("rule", "verdict", "pattern", "rule_path", F.explode("tokens").alias("token"))
    in_rules = stage(wanted.select("token").distinct(), "url-rule-tokens")
    frequency = tokens.join(checked_broadcast(in_rules), "token").groupBy("token").agg(F.count(F.lit(1)).alias("urls"))
    rarest = (
        wanted.join(frequency, "token", "left")
        .groupBy("rule", "verdict", "pattern", "rule_path")
        .agg(F.min(F.struct(F.coalesce("urls", F.lit(0)).alias("urls"), "token"))["token"].alias("token"))
    )
    index = stage(rarest, "url-rule-index")

    candidates = tokens.join(checked_broadcast(index), "token").join(places, "place")
    fitting = candidates.filter(F.expr("host rlike pattern AND startswith(path, rule_path)"))
    best = fitting.groupBy("host", "path").agg(F.min(F.struct((-F.length("rule")).alias("shortness"), "rule", "verdict")).alias("best"))
    return (
        located.join(best, ["host", "path"], "left")
        .select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    )
