"""URL filters as an index of pattern rules, in DataFrame functions only.

A rule is a regular expression with the literal tokens any URL it fits must hold. The index files a
rule under the rarest of them; a URL fetches the rules filed under its own tokens, an equality join,
and only those rules run their expression. Rarity is counted over the URLs themselves.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.tables import UPPER
from tidegauge.sources.values import value_table

TOKEN = r"[^a-z0-9]+"


class Rule(NamedTuple):
    """`pattern` is searched in `host + path`; the fitting rule of the greatest `rank` decides."""

    name: str | None
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    rank: int


def site_rule(verdict: str, site: str) -> Rule:
    """A rule `host/path`: fits the host and all its subdomains, and paths that start with its path.

    Longer rules outrank shorter ones, and pattern rules of the method have rank 0 or less. The
    tokens are the host's labels and the path's pieces that end inside it: a last piece without a
    delimiter behind it may go on in the URL and is no token of it.
    """
    host, slash, path = site.partition("/")
    host, path = host.lower(), slash + path
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}"
    pieces = re.split(TOKEN, path.lower())[:-1]
    tokens = [*re.split(TOKEN, host), *pieces]
    return Rule(site, pattern, tuple(dict.fromkeys(t for t in tokens if t)), verdict, len(site))


def word_rule(verdict: str, words: str) -> Rule:
    """A rule of the method: `words`, joined by hyphens, as whole tokens of a host or path."""
    pattern = rf"(?i)(?<![a-z0-9]){re.escape(words)}(?![a-z0-9])"
    return Rule(None, pattern, tuple(re.split(TOKEN, words.lower())), verdict, 0)


# The site rules of the contract.
SITE_RULES: tuple[Rule, ...] = tuple(
    site_rule(verdict, site)
    for verdict, site in (
        ("allow", "com/"),
        ("block", "example.com/en/"),
        ("allow", "www.example.com/en/"),
        ("block", "net/es/"),
        ("block", "net/fr/"),
    )
)
# Words of sites that sell rather than tell; they decide where no site rule does.
WORD_RULES: tuple[Rule, ...] = tuple(
    word_rule("block", words)
    for words in (
        "cheap-pills", "online-casino", "casino", "free-money", "payday-loans", "replica-watches",
        "porn", "xxx", "sex-cams", "crack-keygen", "warez",
    )
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path: both empty for NULL and where there is no `://`. A-Z of the host is lowered."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower())
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    empty = F.lit("")
    return F.coalesce(host, empty), F.coalesce(path, empty)


def tokens_of(site: Column) -> Column:
    """The distinct tokens of a site; the empty token, which all have, is that of rules without any."""
    return F.array_distinct(F.concat(F.split(F.lower(site), TOKEN), F.array(F.lit(""))))


def rule_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    columns = {"rule": "string", "pattern": "string", "tokens": "string", "verdict": "string", "rank": "int", "place": "int"}
    rows = [(r.name, r.pattern, " ".join(r.tokens), r.verdict, r.rank, i) for i, r in enumerate(rules)]
    return value_table(spark, columns, rows).withColumn("tokens", F.split("tokens", " "))


def index_rules(rules: DataFrame, sites: DataFrame) -> DataFrame:
    """The rules with `token`: the rarest of their tokens among `sites` (host and path in `site`).

    Ties go to the first token by code point; a token no site holds is the rarest of all. Counting
    keeps only tokens that rules have: a semi join whose other side is the rules' tokens.
    """
    wanted = rules.select("place", F.explode_outer("tokens").alias("token"))
    counts = (
        sites.select(F.explode(tokens_of(F.col("site"))).alias("token"))
        .join(wanted.select("token").distinct(), "token", "left_semi")
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )
    rarest = (
        wanted.join(counts, "token", "left")
        .groupBy("place")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)), F.coalesce("token", F.lit("")).alias("token"))).alias("least"))
        .select("place", F.col("least.token").alias("token"))
    )
    return rules.join(rarest, "place").drop("tokens")


def judge(
    pages: DataFrame, rules: Sequence[Rule] = SITE_RULES + WORD_RULES, default: str = "allow",
    id_column: str = "page_id", url: str = "url",
) -> DataFrame:
    """Per page: id, host, path, the site rule that decided (else NULL) and the verdict.

    The fitting rule of the greatest rank decides, then the earlier rule; `default` where none fits.
    Sites are judged once each, so repeated URLs and URLs that differ behind `?` or `#` cost one
    search. The index is joined on the token and left to Catalyst, which knows the size of the
    rules and broadcasts them only under its threshold; beyond it the join is dealt by token, where
    adaptive execution splits a token that most URLs hold. An empty table gives an empty table.
    """
    host, path = url_parts(F.col(url))
    rows = pages.select(F.col(id_column), host.alias("host"), path.alias("path"))
    sites = rows.select("host", "path").distinct().withColumn("site", F.concat("host", "path"))
    index = index_rules(rule_table(pages.sparkSession, rules), sites)
    best = F.max_by(F.struct("rule", "verdict"), F.struct("rank", -F.col("place")))
    judged = (
        sites.select("host", "path", "site", F.explode(tokens_of(F.col("site"))).alias("token"))
        .join(index, "token")
        .filter(F.regexp_like("site", F.col("pattern")))
        .groupBy("host", "path")
        .agg(best.alias("best"))
    )
    return rows.join(judged, ["host", "path"], "left").select(
        id_column, "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
