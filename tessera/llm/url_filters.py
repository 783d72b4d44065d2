"""URL filters: path rules, and trust spread over the link graph for the rest.

A rule allows or blocks the pages of a host (and its subdomains) under a path.
Hosts with allowed pages are trusted seeds, hosts with blocked pages are
distrusted seeds. Trust follows links (personalised PageRank), distrust follows
them backwards, as a page answers for what it links to. Pages without a rule
get the verdict of their host: block where its distrust is above ``MARGIN``
times its trust. Columns and joins only, no Python on executors.

Defined results: a null url, or one without ``://``, has an empty host and path
and no rule; hosts that nothing reaches are allowed; repeated rows get the same
result each; null pages have no links; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lower_ascii
from tessera.plans.cut import written

#: Share of a score that goes on along links, steps, and steps between written tables.
DAMPING, STEPS, WRITE_EVERY = 0.85, 12, 4
#: Block a host whose distrust is above so many times its trust.
MARGIN = 2.0
#: Copies of the small side where one host may hold a third of all rows.
SALTS = 16
#: Links that name a host, with or without a scheme.
LINK = r"""(?i)\bhref\s{0,9}=\s{0,9}["']?\s{0,9}(?:[a-z][a-z0-9+.-]{0,15}:)?//([^/?#"'\s<>]+)"""


@dataclass(frozen=True)
class PathRule:
    """``pattern`` is a host, then a path that the url's path starts with."""

    pattern: str
    allow: bool

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


# The production rules.
RULES = [
    PathRule("org/", True),
    PathRule("example.org/es/", False),
    PathRule("example.org/en/1", False),
    PathRule("com/fr/", True),
    PathRule("com/de/", False),
]


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[PathRule]) -> Column:
    """The pattern of the longest rule that fits, or null."""
    fitting = F
    for rule in sorted(rules, key=lambda r: (-len(r.pattern), r.pattern)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        fitting = fitting.when(fits, F.lit(rule.pattern))
    return fitting if rules else F.lit(None).cast("string")


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``src, dst``: distinct links between different hosts."""
    links = pages.select(
        host_of(F.col(f"`{url}`")).alias("src"),
        F.explode(F.array_distinct(F.transform(
            F.regexp_extract_all(F.coalesce(F.col(f"`{html}`"), F.lit("")), F.lit(LINK), F.lit(1)), lower_ascii
        ))).alias("dst"),
    )
    return links.where("src <> dst and src <> ''").distinct()


def propagate(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """``host, trust, distrust`` after ``STEPS`` steps; ``seeds`` has ``host, allowed, blocked`` counts."""
    edges = written(edges, "host-edges")
    both = F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("src").alias("from"), F.col("dst").alias("to")),
        F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("from"), F.col("src").alias("to")),
    )
    directed = edges.select(F.inline(both))
    degree = directed.groupBy("kind", "from").agg(F.count("*").alias("degree"))
    # Hubs: the edges of one host are dealt over salts, its degree and score go to each.
    salt = F.pmod(F.xxhash64("to"), F.lit(SALTS)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    directed = written(
        directed.withColumn("salt", salt)
        .join(degree.withColumn("salt", salts), ["kind", "from", "salt"])
        .select("kind", "from", "salt", "to", (1 / F.col("degree")).alias("share")),
        "host-shares",
    )
    total = seeds.agg(F.sum("allowed").alias("all_allowed"), F.sum("blocked").alias("all_blocked"))
    start = written(
        seeds.crossJoin(F.broadcast(total)).select(F.inline(F.array(
            F.struct(F.lit("trust").alias("kind"), "host", F.try_divide("allowed", "all_allowed").alias("score")),
            F.struct(F.lit("distrust").alias("kind"), "host", F.try_divide("blocked", "all_blocked").alias("score")),
        ))).where("score > 0"),
        "host-seeds",
    )
    base = start.withColumn("score", F.col("score") * (1 - DAMPING))
    ranks = base
    for step in range(1, STEPS + 1):
        sent = (
            ranks.withColumnRenamed("host", "from").withColumn("salt", salts)
            .join(directed, ["kind", "from", "salt"])
            .select("kind", F.col("to").alias("host"), (F.col("score") * F.col("share") * DAMPING).alias("score"))
        )
        ranks = base.unionByName(sent).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if step % WRITE_EVERY == 0:
            ranks = written(ranks, "host-ranks")
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
    return ranks.groupBy("host").agg(of("trust"), of("distrust"))


def judge(pages: DataFrame, rules: list[PathRule] | None = None, url: str = "url", html: str = "html") -> DataFrame:
    """``page`` (the whole row), ``host, path, rule, verdict`` for every page."""
    rules = RULES if rules is None else rules
    rows = pages.select(
        F.struct("*").alias("page"), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path")
    )
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    allows = [r.pattern for r in rules if r.allow]
    allowed = F.col("rule").isin(allows)
    seeds = rows.where("host <> ''").groupBy("host").agg(
        F.count_if(allowed).alias("allowed"), F.count_if(F.col("rule").isNotNull() & ~allowed).alias("blocked")
    )
    scores = propagate(host_edges(pages, url, html), seeds)
    bad = scores.where(F.col("distrust") > MARGIN * F.col("trust")).select(
        F.col("host").alias("bad_host"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("bad_salt")
    )
    # The row's own salt: a host with a third of all pages is dealt over SALTS tasks.
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int"))
    joined = rows.join(bad, (F.col("host") == F.col("bad_host")) & (F.col("salt") == F.col("bad_salt")), "left")
    verdict = (
        F.when(allowed, "allow")
        .when(F.col("rule").isNotNull(), "block")
        .when(F.col("bad_host").isNotNull(), "block")
        .otherwise("allow")
    )
    return joined.select("page", "host", "path", "rule", verdict.alias("verdict"))
