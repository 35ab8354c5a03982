"""Empirical-Bayes reputation of hosts for URL filters.

Every page with a known outcome (good or bad) counts for its host, the host's registered domain and
the domain's public suffix.  Each level shrinks towards the one above by a beta-binomial prior whose
mean is the posterior mean above and whose strength comes from the spread of the rates at that
level (moments): suffix towards all pages, domain towards its suffix, host towards its domain.  A
page is blocked if the lower posterior bound of its host's bad rate is over the limit, that is, if the
host is bad beyond doubt.  Hosts without outcomes take the posterior of the nearest level that has some.

Defined results: a null url, or one without ``://``, has empty host and path, matches no rule and is
judged like an unknown host; a null outcome says nothing; repeated rows count as often as they
come; without any outcome nothing is blocked.  Other columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Second-level labels that belong to the public suffix.
SUFFIX_LABELS = ["co", "com", "org", "net", "ac", "gov", "edu"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEVELS = ["suffix", "domain", "host"]


def host_of(url: str = "url") -> Column:
    raw = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, UPPER, LOWER)


def path_of(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def with_levels(df: DataFrame) -> DataFrame:
    """Adds ``domain`` and ``suffix`` of ``host``: the suffix is the last label, or the last two where the
    last has two letters and the one before is a known second-level label; the domain has one label more."""
    parts = F.split("host", r"\.")
    n = F.size(parts)
    two = (F.length(F.element_at(parts, -1)) == 2) & (n >= 3) & F.get(parts, n - 2).isin(SUFFIX_LABELS)
    labels = F.when(two, 2).otherwise(1)

    def last(k):
        return F.array_join(F.slice(parts, F.greatest(F.lit(1), n - k + 1), F.least(n, k)), ".")
    return df.withColumn("suffix", last(labels)).withColumn("domain", last(labels + 1))


def rule_of(rules: list[tuple[str, str, str]], host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """The longest rule (verdict, host, path) that fits, as text, and its verdict; null without one.
    A rule fits its host and all subdomains where the path starts with the rule's."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, own, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):
        fits = ((F.col(host) == own) | F.col(host).endswith("." + own)) & F.col(path).startswith(start)
        text, verdict = F.when(fits, own + start).otherwise(text), F.when(fits, said).otherwise(verdict)
    return text, verdict


def _moments(rates: DataFrame) -> Column:
    """Strength of a beta prior: prior weight s in which the spread of the rates around the means
    above is m (1 - m) / (1 + s), beside the binomial spread; between 1 and 1000."""
    n, x, m = F.col("n").cast("double"), F.col("bad").cast("double"), F.col("mean")
    spread = F.sum((x - n * m) * (x - n * m) - n * m * (1 - m))
    whole = F.sum(n * (n - 1) * m * (1 - m))
    rho = spread / whole  # intra-level correlation: 1 / (1 + s)
    return F.when(whole > 0, F.least(F.lit(1000.0), F.greatest(F.lit(1.0), 1 / F.greatest(rho, F.lit(1e-3)) - 1))).otherwise(F.lit(1.0))


def posteriors(outcomes: DataFrame, z: float) -> dict[str, DataFrame]:
    """Tables host, domain and suffix with the name, posterior ``mean`` and lower bound ``low`` of the bad rate.
    ``outcomes`` has host, domain, suffix and bad (0 or 1) of each judged page."""
    top = outcomes.agg(F.count("bad").alias("n"), F.sum("bad").alias("bad")).select(
        ((F.coalesce("bad", F.lit(0)) + 0.5) / (F.col("n") + 1.0)).alias("mean"))
    by_host = outcomes.groupBy("host", "domain", "suffix").agg(F.count("bad").alias("n"), F.sum("bad").alias("bad"))
    above: DataFrame | None = None
    out = {}
    for i, level in enumerate(LEVELS):
        own = by_host.groupBy(LEVELS[:i + 1]).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        own = own.join(above.select(*LEVELS[:i], "mean"), LEVELS[:i]) if i else own.join(F.broadcast(top))
        strength = own.agg(_moments(own).alias("s"))
        a = F.col("mean") * F.col("s") + F.col("bad")
        b = (1 - F.col("mean")) * F.col("s") + F.col("n") - F.col("bad")
        mean = a / (a + b)
        low = mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1))
        above = own.join(F.broadcast(strength)).select(*LEVELS[:i + 1], mean.alias("mean"), low.alias("low"))
        out[level] = above
    return out


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]], limit: float = 0.5, z: float = 1.6449,
          url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default page_id) of every page with host, path, rule, verdict, the posterior
    ``bad_rate`` and its lower bound ``bad_low``.  ``outcomes``: url and bad (0, 1 or null) of judged pages."""
    keep = keep or ["page_id"]
    src = pages.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], host_of(url).alias("host"), path_of(url).alias("path"))
    known = with_levels(outcomes.where("bad IS NOT NULL").select(host_of("url").alias("host"), F.col("bad").cast("long").alias("bad")).where("host <> ''"))
    # every host finds its nearest level with outcomes once; the pages are joined to their hosts only
    tables, names = posteriors(known, z), with_levels(src.select("host").distinct())
    for level in reversed(LEVELS):
        own = tables[level].select(F.col(level), F.col("mean").alias(f"{level}_mean"), F.col("low").alias(f"{level}_low"))
        names = names.join(own, level, "left")
    near = [F.coalesce(*[F.col(f"{lv}_{what}") for lv in reversed(LEVELS)]).alias(f"near_{what}") for what in ("mean", "low")]
    src = src.join(names.select("host", *near), "host")
    rate, low = F.col("near_mean"), F.col("near_low")
    rule, said = rule_of(rules)
    verdict = F.coalesce(said, F.when(low > limit, "block").otherwise("allow"))
    return src.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "host", "path", rule.alias("rule"), verdict.alias("verdict"),
                      rate.alias("bad_rate"), low.alias("bad_low"))
