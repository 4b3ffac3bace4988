"""URL filters: rules first, then the reputation of the host.

Labelled pages give each host a count of good and bad outcomes. Rates are
shrunk step by step: a suffix towards all pages, a registered domain towards
its suffix, a host towards its domain. Each step is a beta-binomial model whose
prior mean is the parent's posterior mean and whose strength is fitted to the
spread of the parent's children (moments). A page is blocked if the lower
bound of its host's posterior bad rate is above a threshold.

Defined cases: a null URL, or one without ``://``, has an empty host and path,
and so the reputation of the empty host. A host without labels has its domain's
posterior, and so on. Repeated rows count as often as they stand. An empty
table gives an empty one. Clashing columns are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptrail.llm.tables import same, settle

# Suffixes of two labels under which names are registered.
LONG_SUFFIXES = (
    "ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx",
    "com.tr", "com.tw", "edu.au", "gov.au", "gov.uk", "ne.jp", "net.au", "or.jp", "org.au", "org.uk",
)
LEVELS = ("suffix", "domain", "host")


@dataclass(frozen=True)
class Rule:
    """``block net/``: a host with its subdomains, and how the path begins."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


@dataclass(frozen=True)
class Reputation:
    """threshold on the bad rate, standard deviations of the bound, limits of a prior's strength."""

    threshold: float = 0.5
    deviations: float = 1.0
    weakest: float = 1.0
    strongest: float = 200.0


def address(df: DataFrame, url: str = "url") -> DataFrame:
    """Add the host, A-Z lower-cased, and the path."""
    rest = F.when(F.col(url).contains("://"), F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    host = F.translate(F.regexp_extract("_rest", r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)
    return df.withColumn("_rest", F.coalesce(rest, F.lit(""))).withColumn("host", host).withColumn("path", path).drop("_rest")


def decided(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The pattern and verdict of the longest rule that fits, else nulls."""
    pattern, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        fits = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        fits = fits & F.col("path").startswith(rule.path)
        pattern, verdict = F.when(fits, F.lit(rule.pattern)).otherwise(pattern), F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return pattern, verdict


def _levels(host: str = "host") -> dict[str, Column]:
    labels = F.split(F.col(host), r"\.")
    tail = lambda n: F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), F.lit(n)), ".")
    wide = tail(2).isin(*LONG_SUFFIXES)
    return {"suffix": F.when(wide, tail(2)).otherwise(tail(1)), "domain": F.when(wide, tail(3)).otherwise(tail(2))}


def _shrunk(children: DataFrame, parents: DataFrame, by: str, options: Reputation) -> DataFrame:
    """Children (by, n, bad, ...) with their parent's rate as prior: adds rate and strength."""
    n, bad = F.col("n").cast("double"), F.col("bad").cast("double")
    labelled = F.col("n") > 0
    sums = children.groupBy(by).agg(
        F.sum(n).alias("all_n"), F.sum(bad).alias("all_bad"), F.sum(n * n).alias("squares"),
        F.coalesce(F.sum(F.when(labelled, F.try_divide(bad * bad, n))), F.lit(0.0)).alias("rates"), F.count(F.when(labelled, 1)).alias("members"),
    )
    mean = F.coalesce(F.try_divide("all_bad", "all_n"), F.lit(0.0))
    noise = mean * (1 - mean)
    spread = F.col("rates") - F.col("all_n") * mean * mean - noise * (F.col("members") - 1)
    mean_size = F.coalesce(F.try_divide("squares", "all_n"), F.lit(0.0))
    scale = noise * (F.col("all_n") - mean_size - (F.col("members") - 1))
    within = F.when((scale > 0) & (spread > 0), F.least(F.try_divide(spread, scale), F.lit(1.0))).otherwise(F.lit(0.0))
    fitted = F.when(within > 0, F.try_divide(F.lit(1.0), within) - 1).otherwise(F.lit(options.strongest))
    strength = F.greatest(F.lit(options.weakest), F.least(F.lit(options.strongest), fitted))
    # A parent whose children all agree says nothing of their spread.
    strength = F.when((F.col("members") > 1) & (noise > 0), strength).otherwise(F.lit(options.weakest))
    priors = sums.select(by, strength.alias("prior")).join(parents.select(by, F.col("rate").alias("parent")), by)
    out = settle(children, "hosts").join(settle(priors, "host-priors"), by)
    rate = (F.col("bad") + F.col("parent") * F.col("prior")) / (F.col("n") + F.col("prior"))
    return out.withColumn("rate", rate).withColumn("strength", F.col("n") + F.col("prior")).drop("prior", "parent")


def reputations(pages: DataFrame, options: Reputation = Reputation()) -> DataFrame:
    """(host, n, bad, rate, strength, bound) from (host, bad), where bad is 1, 0 or null for unlabelled."""
    hosts = pages.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
    hosts = settle(hosts.withColumns(_levels()).withColumn("everything", F.lit("")), "host-counts")
    domains = hosts.groupBy("domain", "suffix", "everything").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix", "everything").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    start = suffixes.groupBy("everything").agg(((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("rate"))
    suffixes = _shrunk(suffixes, start, "everything", options)
    domains = _shrunk(domains, suffixes, "suffix", options)
    out = _shrunk(hosts, domains, "domain", options)
    error = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("strength") + 1))
    return out.select("host", "n", "bad", "rate", "strength", (F.col("rate") - options.deviations * error).alias("bound"))


def judge(pages: DataFrame, rules: Sequence[Rule], options: Reputation = Reputation(), outcome: Column | None = None) -> DataFrame:
    """All pages with host, path, rule, verdict and the host's bound.

    ``outcome`` is 1 for a bad page, 0 for a good one, null if unlabelled.
    Without it the pages that a rule decides are the labelled ones.
    """
    pattern, verdict = decided(rules)
    rows = address(pages.drop("host", "path", "rule", "verdict", "bound"))
    rows = rows.withColumn("rule", pattern).withColumn("_ruled", verdict)
    bad = F.when(F.col("_ruled") == "block", 1).when(F.col("_ruled") == "allow", 0) if outcome is None else outcome
    known = settle(reputations(rows.select("host", bad.cast("int").alias("bad")), options), "host-reputations")
    known = known.select(F.col("host").alias("known_host"), "bound")
    joined = rows.join(known, same(rows["host"], known["known_host"])).drop("known_host")
    method = F.when(F.col("bound") > options.threshold, "block").otherwise("allow")
    return joined.withColumn("verdict", F.coalesce(F.col("_ruled"), method)).drop("_ruled")
