"""URL filter: explicit rules first, then the host's empirical-Bayes reputation.

Labelled page outcomes (bad or not) are counted per host. Bad rates are shrunk along
suffix, registered domain and host: each level's rate has a beta prior around the
posterior mean of the level above, taken without the unit's own outcomes so that none
counts twice; its weight is estimated from all units of the level by the moments of
the beta-binomial. A page is blocked when the lower bound of
its host's posterior bad rate is above a limit; a host without labels stands on its
domain's posterior as its prior, so little evidence does not block.

Pages are joined to hosts that have labels, hosts being counted with partial sums
first; one host with a third of all pages is a skewed join that adaptive execution
splits. Rules are a list a person writes and become one literal map.

Defined cases: a null url or one without ``://`` has an empty host and path and is
allowed; repeated rows are judged alike; a null outcome does not count; several
outcomes of a page all count; extra columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidlens.session import cut_lineage

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.jp", "com.br", "co.in", "com.cn", "co.nz")
BAD_LIMIT = 0.5
BOUND_Z = 1.645
RHO_RANGE = (1e-4, 1 / 3)  # a prior weighs at least two outcomes, so a single one never decides


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


RULES = (Rule("net", "/", "block"), Rule("example.net", "/en/", "allow"), Rule("example.com", "/de/", "block"),
         Rule("org", "/fr/", "allow"))


def host_of(url: Column) -> Column:
    host = F.translate(F.regexp_extract(url, PARTS, 1), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule (host, path, verdict) that fits, else null."""
    by_host: dict[str, list[Rule]] = {}
    for rule in rules:
        by_host.setdefault(rule.host, []).append(rule)
    if not by_host:
        return F.lit(None).cast("struct<size:int,host:string,path:string,verdict:string>")
    known = F.create_map(*[x for name, group in by_host.items() for x in (F.lit(name), F.array(*[
        F.struct(F.lit(len(r.host) + len(r.path)).alias("size"), F.lit(r.host).alias("host"),
                 F.lit(r.path).alias("path"), F.lit(r.verdict).alias("verdict")) for r in group]))])
    labels = F.split(host, r"\.")
    names = F.transform(F.sequence(F.lit(1), F.size(labels)),
                        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = F.flatten(F.transform(names, lambda n: F.coalesce(F.try_element_at(known, n), F.array())))
    return F.array_max(F.filter(fitting, lambda r: path.startswith(r.path)))


def with_units(rows: DataFrame, suffixes: Sequence[str] = LONG_SUFFIXES) -> DataFrame:
    """Add the units a host belongs to: site (host without user and port), domain and suffix.

    ``suffixes`` are those of several labels, with ``*.`` and ``!`` as in the public list; the longest that fits
    holds, else the last label.
    """
    site = F.regexp_replace(F.regexp_replace("host", r"^[^@]*@", ""), r"\.?(:[0-9]*)?$", "")
    address = F.col("site").rlike(r"^[0-9.]+$|^\[")
    domain, suffix = F.when(address, F.col("site")), F.when(address, F.lit(""))
    for n in range(max([x.count(".") + 1 for x in suffixes], default=1), 1, -1):
        own = [x for x in suffixes if x.count(".") + 1 == n]
        last = F.substring_index("site", ".", -n)
        fits = last.isin([x for x in own if x[0] not in "*!"])
        if wild := [x[2:] for x in own if x[0] == "*"]:
            labels = F.size(F.split("site", r"\."))
            fits |= (labels >= n) & F.substring_index("site", ".", 1 - n).isin(wild)
        fits &= ~last.isin([x[1:] for x in own if x[0] == "!"])
        domain, suffix = domain.when(fits, F.substring_index("site", ".", -n - 1)), suffix.when(fits, last)
    return rows.withColumn("site", site).withColumns({
        "domain": domain.otherwise(F.substring_index("site", ".", -2)),
        "suffix": suffix.otherwise(F.substring_index("site", ".", -1))})


def _prior_weight(units: DataFrame) -> float:
    """Weight of the prior (units: n, bad, parent) by the moments of the beta-binomial, summed over all units."""
    p = F.col("parent")
    s, a, b = units.agg(
        F.sum((F.col("bad") - F.col("n") * p) * (F.col("bad") - F.col("n") * p)),
        F.sum(F.col("n") * p * (1 - p)), F.sum(F.col("n") * (F.col("n") - 1) * p * (1 - p))).first()
    low, high = RHO_RANGE
    rho = min(max((s - a) / b, low), high) if b else high
    return 1 / rho - 1


def _bound(mean: Column, size: Column | float) -> Column:
    """Lower bound of a beta distribution with this mean and sum of parameters."""
    return mean - BOUND_Z * F.sqrt(mean * (1 - mean) / (size + 1))


class Reputation(NamedTuple):
    """Posterior means by level, the sites' lower bounds, and what a unit without outcomes falls back on."""

    levels: dict[str, DataFrame]
    site_weight: float
    overall: float


def reputation(pages: DataFrame, outcomes: DataFrame, suffixes: Sequence[str] = LONG_SUFFIXES) -> Reputation:
    """Posterior bad rates per site, domain and suffix that has outcomes.

    ``pages`` has page_id and host; ``outcomes`` has page_id and bad (boolean).
    """
    counts = with_units(pages.join(outcomes.filter(F.col("bad").isNotNull()), "page_id").filter("host <> ''")
                        .groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad")), suffixes)
    sites = cut_lineage(counts.groupBy("site", "domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")),
                        "sites")
    total, bad = sites.agg(F.sum("n"), F.sum("bad")).first()
    overall = ((bad or 0) + 0.5) / ((total or 0) + 1)
    levels, above, weight = {}, None, 1.0
    for level, keys in (("suffix", ["suffix"]), ("domain", ["domain", "suffix"]), ("site", ["site", "domain"])):
        units = sites.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        if above is None:
            units = units.withColumn("parent", F.lit(overall))
        else:
            rest = F.col("above_n") - F.col("n")
            units = units.join(above, keys[1]).withColumn(
                "parent", (F.col("above_bad") - F.col("bad") + F.col("above_pull")) / (rest + F.col("above_weight")))
        weight = _prior_weight(units)
        mean = (F.col("bad") + weight * F.col("parent")) / (F.col("n") + weight)
        levels[level] = units.select(level, mean.alias(f"{level}_mean"),
                                     _bound(mean, F.col("n") + weight).alias(f"{level}_bound"))
        above = units.select(level, F.col("n").alias("above_n"), F.col("bad").alias("above_bad"),
                             (weight * F.col("parent")).alias("above_pull"), F.lit(weight).alias("above_weight"))
    return Reputation(levels, weight, overall)


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule] = RULES, limit: float = BAD_LIMIT,
          suffixes: Sequence[str] = LONG_SUFFIXES) -> DataFrame:
    """One row per page (page_id, url): host, path, the rule that fits, and the verdict."""
    parts = pages.select(F.col("page_id").cast("long"), host_of(F.col("url")).alias("host"),
                         path_of(F.col("url")).alias("path"))
    known = reputation(parts, outcomes, suffixes)
    found = with_units(parts, suffixes)
    for level, column in (("site", "site_bound"), ("domain", "domain_mean"), ("suffix", "suffix_mean")):
        found = found.join(known.levels[level].select(level, column), level, "left")
    prior = F.coalesce("domain_mean", "suffix_mean", F.lit(known.overall))
    bound = F.coalesce("site_bound", _bound(prior, known.site_weight))
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    return found.withColumns({"_rule": rule, "bad_bound": bound}).select(
        "page_id", "host", "path", F.concat("_rule.host", "_rule.path").alias("rule"),
        F.when(F.col("_rule").isNotNull(), F.col("_rule.verdict")).when((F.col("host") != "") & (F.col("bad_bound") > limit), "block")
        .otherwise("allow").alias("verdict"))
