"""URL filter: host reputation by empirical Bayes, and explicit rules that come first.

Labelled page outcomes are counted for each host, registered domain and suffix. Each level is a
beta-binomial whose prior mean is the shrunken rate of the level above and whose strength comes from how
much the groups of the level differ (method of moments). A host is blocked when the lower posterior bound
of its rate of bad pages is above a threshold. All of it is DataFrame expressions; counts are combined by
each task before they are shuffled, and the join that brings the hosts' verdicts back to the pages is one
Spark can split at a hot host.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourgrid.session import stored

#: Host, path, verdict.
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
STRENGTH = (1.0, 1000.0)
Z, LIMIT = 1.645, 0.5


def host_and_path(url: Column) -> dict[str, Column]:
    """``host`` with A-Z lower-cased and ``path``; both empty for a null url or one without ``://``."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, URL, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return {"host": host, "path": F.regexp_extract(url, URL, 2)}


def rule_of(rules: Sequence[tuple[str, str, str]], verdict: bool) -> Column:
    """The longest rule that fits ``host`` and ``path``, or its verdict; null if none fits."""
    longest = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    found = []
    for host, path, says in longest:
        fits = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        found.append(F.when(fits & F.col("path").startswith(path), F.lit(says if verdict else host + path)))
    return F.coalesce(*found, F.lit(None).cast("string"))


def registered(host: Column) -> dict[str, Column]:
    """Registered domain and suffix: the last two labels, and the last one."""
    return {"domain": F.substring_index(host, ".", -2), "suffix": F.substring_index(host, ".", -1)}


def _shrunk(groups: DataFrame, strength: float) -> DataFrame:
    """``rate``: the posterior mean of each group, from its ``bad`` of ``n`` pages and its prior mean ``mu``."""
    return groups.withColumn("rate", (F.col("bad") + strength * F.col("mu")) / (F.col("n") + strength))


def _strength(groups: DataFrame) -> float:
    """Prior strength for groups with ``bad`` of ``n`` pages and prior mean ``mu``.

    Moments: the spread of the groups' rates beyond what chance gives is an intraclass correlation r, and
    the strength is 1 / r - 1, kept within ``STRENGTH``; the greatest, where the groups do not differ.
    """
    chance = F.col("mu") * (1 - F.col("mu"))
    off = F.col("bad") / F.col("n") - F.col("mu")
    seen, expected, more = groups.agg(
        F.sum(F.col("n") * off * off), F.sum(chance), F.sum((F.col("n") - 1) * chance)
    ).first()
    low, high = STRENGTH
    if not more or seen <= expected:
        return high
    return round(min(max(more / (seen - expected) - 1, low), high), 6)


def reputation(outcomes: DataFrame, z: float = Z, limit: float = LIMIT) -> DataFrame:
    """One row for each host of ``outcomes`` (host, bad 0 or 1): host, n, rate, bound, verdict.

    Rows without host or ``bad`` are no outcome. A host with few outcomes stays near its domain's rate, a
    domain near its suffix's, a suffix near the rate of all. ``bound`` lies ``z`` posterior standard deviations
    below the host's rate; above ``limit`` the host is blocked. Without any outcome there are no rows.
    """
    known = outcomes.where(F.col("bad").isNotNull() & F.col("host").isNotNull())
    hosts = known.groupBy("host").agg(F.sum(F.col("bad").cast("double")).alias("bad"), F.count("*").alias("n"))
    hosts = stored(hosts.withColumns(registered(F.col("host"))), "hosts")
    sums = [F.sum("bad").alias("bad"), F.sum("n").alias("n")]
    bad, n = hosts.agg(*sums).first()
    whole = ((bad or 0.0) + 1) / ((n or 0) + 2)

    suffixes = hosts.groupBy("suffix").agg(*sums).withColumn("mu", F.lit(whole))
    suffixes = _shrunk(suffixes, _strength(suffixes)).select("suffix", F.col("rate").alias("mu"))
    domains = hosts.groupBy("domain", "suffix").agg(*sums).join(suffixes, "suffix")
    domains = _shrunk(domains, _strength(domains)).select("domain", F.col("rate").alias("mu"))
    hosts = hosts.join(domains, "domain")
    strength = _strength(hosts)
    hosts = _shrunk(hosts, strength)
    spread = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + strength + 1))
    bound = F.col("rate") - z * spread
    verdict = F.when(bound > limit, "block").otherwise("allow")
    return hosts.select("host", "n", "rate", bound.alias("bound"), verdict.alias("verdict"))


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, z: float = Z, limit: float = LIMIT
) -> DataFrame:
    """One row for each row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, bound.

    The longest rule that fits decides, else the host's reputation by ``outcomes`` (host, bad); a host
    without outcomes is allowed. Null urls and urls without ``://`` have an empty host and path. Null or
    repeated ids are kept; other columns are ignored.
    """
    found = pages.select("page_id", F.col("url").alias("url")).withColumns(host_and_path(F.col("url")))
    known = reputation(outcomes, z, limit).select("host", "bound", F.col("verdict").alias("by_host"))
    found = found.withColumns({"rule": rule_of(rules, False), "by_rule": rule_of(rules, True)})
    verdict = F.coalesce("by_rule", "by_host", F.lit("allow"))
    return found.join(known, "host", "left").select("page_id", "host", "path", "rule", verdict.alias("verdict"), "bound")
