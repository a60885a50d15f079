"""Operator 1 [native]: URL filter by rules and empirical-Bayes host reputation.

A labelled page is a success or not.  A host's success rate has a beta prior
around its registered domain's posterior mean, the domain's one around its
suffix's, the suffix's one around the rate of all pages.  How tightly groups of a
level hold to their parent is learned from all of them: with mean m above, the
beta-binomial has E(y - n m)^2 = n m (1 - m) (1 + (n - 1) r), so r is the moment
estimate over the level's groups and the prior's weight is 1 / r - 1.  A host is
allowed if the lower bound of its posterior (mean less ``z`` standard deviations)
reaches ``least``.  Explicit rules come first.

A null URL, or one without "://", has an empty host and path and is judged as
that host.  Repeated pages count and return each.  Pages without a label count
for nothing but are judged; without any label all rates are 1/2.  Of repeated
labels the worse counts.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitchhouse.llm.common import ascii_lower, stored

#: (verdict, host, path): the contract's rules.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
#: Public suffixes of two labels; all others are taken as one label.
SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn",
            "com.mx", "com.tr", "com.tw", "edu.au", "gov.au", "gov.uk", "net.au", "ne.jp", "or.jp", "org.au", "org.uk")
LEAST, Z = 0.5, 1.2816
#: Bounds of the estimate r: groups that all agree still get a prior, and no prior weighs nothing.
R_RANGE = (1e-3, 0.5)


def host_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def registered(host: Column) -> tuple[Column, Column]:
    """(registered domain, public suffix) of a host."""
    labels = F.split(host, r"\.")
    two = F.concat_ws(".", F.slice(labels, F.greatest(F.lit(1), F.size(labels) - 1), 2))
    n = F.when(two.isin(*SUFFIXES), 2).otherwise(1)
    last = lambda k: F.concat_ws(".", F.slice(labels, F.greatest(F.lit(1), F.size(labels) - k + 1), k))
    return last(n + 1), last(n)


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """(verdict, rule) of the longest rule that fits, else null.  Of two equally
    long ones the one with the longer host wins.  A short list, kept in the plan."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r))
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(v).alias("verdict"), F.lit(h + p).alias("rule"))) for v, h, p in order]
    return F.coalesce(*fits, F.lit(None).cast("struct<verdict:string,rule:string>"))


def _spread(groups: DataFrame, m: str) -> float:
    """The moment estimate r for groups (n, y) around the means ``m``."""
    excess = (F.col("y") - F.col("n") * F.col(m)) ** 2 / (F.col(m) * (1 - F.col(m))) - F.col("n")
    got = groups.agg(F.round(F.sum(excess) / F.nullif(F.sum(F.col("n") * (F.col("n") - 1)), F.lit(0)), 6)).first()[0]
    return min(max(got, R_RANGE[0]), R_RANGE[1]) if got is not None else R_RANGE[1]


def _mean(m: str, r: float) -> Column:
    k = F.lit(1 / r - 1)
    return (k * F.col(m) + F.col("y")) / (k + F.col("n"))


def reputations(outcomes: DataFrame) -> DataFrame:
    """(host, mean, deviation) from ``outcomes`` (host, y), y null without a label:
    the posterior of every host's success rate."""
    domain, suffix = registered(F.col("host"))
    hosts = stored(outcomes.groupBy("host").agg(F.count("y").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("y"))
                   .withColumn("domain", domain).withColumn("suffix", suffix), "hosts")
    total = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("y"), F.lit(0))).first()
    suffixes = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y")) \
        .withColumn("m0", F.lit((total[1] + 1) / (total[0] + 2)))
    suffixes = suffixes.withColumn("m1", _mean("m0", _spread(suffixes, "m0"))).select("suffix", "m1")
    domains = (hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
               .join(suffixes, "suffix"))
    domains = domains.withColumn("m2", _mean("m1", _spread(domains, "m1"))).select("suffix", "domain", "m2")
    below = stored(hosts.join(domains, ["suffix", "domain"]), "host-priors")
    k = F.lit(1 / _spread(below, "m2") - 1)
    a, b = k * F.col("m2") + F.col("y"), k * (1 - F.col("m2")) + F.col("n") - F.col("y")
    return (below.withColumn("a", a).withColumn("b", b)
            .select("host", (F.col("a") / (F.col("a") + F.col("b"))).alias("mean"),
                    F.sqrt(F.col("a") * F.col("b") / ((F.col("a") + F.col("b")) * (F.col("a") + F.col("b"))
                                                      * (F.col("a") + F.col("b") + 1))).alias("deviation")))


def judged(pages: DataFrame, labels: DataFrame, rules: tuple = RULES, least: float = LEAST, z: float = Z,
           id_col: str = "page_id", url_col: str = "url", label_id: str = "doc_id") -> DataFrame:
    """A row per page: host, path, the rule that fits, the verdict, and the
    posterior mean and lower bound of its host.  The label of a page is that of
    the document with its id; a success is of good quality and not toxic."""
    host, path = host_path(F.col(url_col))
    base = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    known = (labels.where(F.col("quality").isNotNull()).groupBy(F.col(label_id).alias("_label"))
             .agg(F.min(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0)).alias("y")))
    outcomes = base.select("page_id", "host").join(known, F.col("page_id") == F.col("_label"), "left").select("host", "y")
    found = reputations(outcomes)
    bound = F.round(F.col("mean") - z * F.col("deviation"), 6)
    return (base.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules)).join(found, "host")
            .select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce("fit.verdict", F.when(bound >= least, "allow").otherwise("block")).alias("verdict"),
                    F.round("mean", 6).alias("host_mean"), bound.alias("host_bound")))
