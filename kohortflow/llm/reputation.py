"""URL filter by rules and by an empirical-Bayes reputation of hosts.

A host's share of good pages is shrunk towards its registered domain's, that towards its suffix's, and that towards
the share of all labelled pages, by beta-binomial priors. How strongly is learnt from the labels: for each level the
moments of the groups' shares give the between-group variance, and so the number of pages a prior is worth. A host
passes if the lower bound of its posterior reaches a threshold; a host without labels is judged by its domain, and so
on. Explicit rules go first: the longest rule that fits decides.

Everything is aggregation by host and joins; the driver sees three counts per level. A host with very many pages is
combined in the map tasks, and the join back is one that AQE splits.

Defined results: a null url, or one without ``://``, has an empty host and path and is judged like a host named "".
Labels that are null are left out; repeated labels count each. Repeated pages are judged each. Columns other than
those named are not read. An empty table gives an empty result; without labels the threshold decides on a share of one half.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed by the contract: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Suffixes of two labels under which names are registered; a parameter, not a full public list.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.uk", "com.au", "com.br", "org.uk")
DEVIATIONS = 1.645  # one-sided 95 percent
THRESHOLD = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    return F.when(F.substring_index(host, ".", -2).isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


@dataclass(frozen=True)
class Level:
    """What one level learns from its groups: the overall share and the pages its prior is worth."""

    mean: float
    strength: float


def level_of(groups: DataFrame) -> Level:
    """Moments of the shares of (good, n): the between-group variance by the analysis of variance of binomials."""
    g, n, n2, k, within = groups.where("n > 0").agg(
        F.sum("good"), F.sum("n"), F.sum(F.col("n") * F.col("n")), F.count("*"), F.sum(F.col("good") * F.col("good") / F.col("n"))
    ).first()
    if not n:
        return Level(0.5, 2.0)
    mean = (g + 1.0) / (n + 2.0)
    spread = mean * (1 - mean)
    squares = within - 2 * mean * g + mean * mean * n  # sum of n * (share - mean)^2
    room = n - n2 / n - (k - 1)
    between = (squares - (k - 1) * spread) / room if room > 0 else 0.0
    share = min(max(between / spread, 0.001), 0.999)
    return Level(mean, min(max(1 / share - 1, 2.0), 1000.0))


def reputations(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, good, n, mean, bound) of every host of ``pages`` (page_id, host), from ``labels`` (page_id, good)."""
    labelled = labels.where("page_id IS NOT NULL AND good IS NOT NULL").groupBy("page_id").agg(F.sum("good").alias("good"), F.count("*").alias("n"))
    hosts = pages.join(labelled, "page_id", "left").groupBy("host").agg(F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    hosts = hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    suffixes = domains.groupBy("suffix").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    by_suffix, by_domain, by_host = (level_of(x) for x in (suffixes, domains, hosts))

    def shrunk(prior: Column, level: Level) -> Column:
        return (F.col("good") + level.strength * prior) / (F.col("n") + level.strength)

    suffixes = suffixes.select("suffix", shrunk(F.lit(by_suffix.mean), by_suffix).alias("suffix_mean"))
    domains = domains.join(suffixes, "suffix").select("domain", "suffix", shrunk(F.col("suffix_mean"), by_domain).alias("domain_mean"))
    mean, weight = shrunk(F.col("domain_mean"), by_host), F.col("n") + by_host.strength
    bound = F.col("mean") - DEVIATIONS * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (weight + 1))
    return hosts.join(domains, ["domain", "suffix"]).select("host", "good", "n", mean.alias("mean")).withColumn("bound", bound)


def judged(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict, bound) of every page."""
    placed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    scored = placed.join(reputations(placed.select("page_id", "host"), labels).select("host", "bound"), "host")
    rule, verdict = ruled(F.col("host"), F.col("path"))
    own = F.when(F.col("bound") >= THRESHOLD, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"), "bound")
