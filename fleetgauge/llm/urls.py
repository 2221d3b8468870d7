"""URL filter: rules by host and path, and trust spread over the graph of hosts.

Links between hosts come from the pages. Trust is a personalised PageRank from hosts whose pages
the rules allow; distrust is one over reversed links, from hosts whose pages they block. A url
without a rule is judged by its host: blocked if the distrust that links bring it outweighs the
trust. A host's own seed is no evidence on its other pages, since rules hold for paths.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pinned, table

#: The rules of the task (host and path prefix, verdict).
RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"),
]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINKS = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, NULL if none."""
    fitting = []
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        fitting.append(F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fitting)


def host_links(pages: DataFrame, host: str = "host", page: str = "html") -> DataFrame:
    """(source, target, weight): links between different hosts, counted over all pages."""
    found = F.explode(F.regexp_extract_all(F.coalesce(F.col(page), F.lit("")), F.lit(_LINKS), F.lit(1)))
    links = pages.select(F.col(host).alias("source"), found.alias("target"))
    links = links.withColumn("target", F.translate("target", _UPPER, _LOWER))
    return links.where("source <> target and source <> ''").groupBy("source", "target").agg(F.count(F.lit(1)).alias("weight"))


def spread(links: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-6) -> DataFrame:
    """Personalised PageRank (host, rank, linked) from `seeds` (host, seed; summing to 1) along `links`.

    Each round is one join and one pre-aggregated sum, written as a table; it ends when ranks move
    by less than `tolerance` in total, which the damping brings about. Rank of hosts without links out goes nowhere. `linked` is the
    part of a rank that came over links."""
    out = links.groupBy("source").agg(F.sum("weight").alias("total"))
    shares = pinned(links.join(out, "source").select("source", "target", (F.col("weight") / F.col("total")).alias("share")))
    ranks = pinned(seeds.select("host", F.col("seed").alias("rank")))
    for _ in range(math.ceil(math.log(tolerance / 2) / math.log(damping)) + 1):  # round k moves 2 * damping**k at most
        moved = shares.join(ranks.withColumnRenamed("host", "source"), "source").select(
            F.col("target").alias("host"), (damping * F.col("rank") * F.col("share")).alias("rank")
        )
        base = seeds.select("host", ((1 - damping) * F.col("seed")).alias("rank"))
        after = pinned(moved.union(base).groupBy("host").agg(F.sum("rank").alias("rank")))
        both = after.join(ranks.withColumnRenamed("rank", "old"), "host", "full")
        change = both.agg(F.sum(F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))))).first()[0] or 0.0
        ranks = after
        if change < tolerance:
            break
    own = ranks.join(seeds, "host", "left")
    return own.select("host", "rank", (F.col("rank") - (1 - damping) * F.coalesce("seed", F.lit(0.0))).alias("linked"))


def judged(
    pages: DataFrame, rules: list[tuple[str, str]] = RULES, threshold: float = 1.0, url: str = "url", page: str = "html"
) -> DataFrame:
    """Per row of `pages` (page_id, url, html): page_id, host, path, rule, verdict, trust, distrust.

    A NULL url, or one without ://, has an empty host and path and no rule. The verdict is the
    rule's, else block if distrust exceeds `threshold` times trust, else allow. Hosts that no trust
    or distrust reaches are allowed. Seeds weigh a host by its share of pages with that verdict."""
    rows = pages.select("page_id", F.col(page).alias("html"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    slim = pinned(rows.drop("html").withColumn("found", rule_of(F.col("host"), F.col("path"), rules)))
    links = pinned(host_links(rows))
    marked = pinned(slim.where("found is not null").groupBy("host", "found.verdict").agg(F.count(F.lit(1)).alias("n")))

    def seeds(verdict: str) -> DataFrame:
        chosen = marked.where(F.col("verdict") == verdict)
        total = chosen.agg(F.sum("n")).first()[0] or 1
        return chosen.select("host", (F.col("n") / total).alias("seed"))

    trust = spread(links, seeds("allow")).select("host", F.col("linked").alias("trust"))
    turned = links.select(F.col("target").alias("source"), F.col("source").alias("target"), "weight")
    distrust = spread(turned, seeds("block")).select("host", F.col("linked").alias("distrust"))
    scores = pinned(trust.join(distrust, "host", "full"))
    zero = F.lit(0.0)
    both = slim.join(scores, "host", "left").withColumns({c: F.coalesce(c, zero) for c in ("trust", "distrust")})
    method = F.when(F.col("distrust") > threshold * F.col("trust"), "block").otherwise("allow")
    return both.select("page_id", "host", "path", "found.rule", F.coalesce("found.verdict", method).alias("verdict"), "trust", "distrust")


def query(spark, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
