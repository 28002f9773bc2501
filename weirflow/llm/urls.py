"""URL filters: host reputation by empirical Bayes, with explicit rules above it.

Labelled pages are binomial outcomes of their host. A host's bad rate is shrunk to that of its registered domain, that one to its
suffix, and that to the whole table, each by a beta prior whose weight comes from how much the members differ. A host is blocked if the
lower bound of its posterior bad rate lies above a limit, so a host with little evidence is never blocked by chance.
Built-in expressions only. The pages and their outcomes are read once, to make a table of one row per host; each level is a small
table made of the one before. A page meets the blocked hosts in one join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import saved

#: Rules of (host with its subdomains, beginning of the path, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: The posterior bad rate less Z standard deviations must exceed LIMIT. MOST and LEAST bound a prior's weight, in pages.
LIMIT, Z, LEAST, MOST = 0.3, 1.645, 2.0, 200.0

#: Parts below a country's under which names are registered.
SECOND_LEVEL = ("ac", "co", "com", "edu", "go", "gob", "gov", "gouv", "gv", "ltd", "mil", "ne", "net", "nhs", "nom", "or", "org", "plc", "sch")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(pages: DataFrame) -> DataFrame:
    """``pages`` with host and path; a table's own columns of these names are replaced."""
    at = F.locate("://", F.col("url"))
    rest = F.when(at > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    place = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return pages.withColumns({"host": place, "path": path})


def _fits(rule: tuple[str, str, str]) -> Column:
    name, start, _ = rule
    return ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(start)


def _longest(rules, value) -> Column:
    """``value`` of the longest rule that fits, else null."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[0] + r[1])):
        chosen = F.when(_fits(rule), F.lit(value(rule))).otherwise(chosen)
    return chosen


def _level(stats: DataFrame, *level: str) -> DataFrame:
    """Totals per member of a level, ``stats`` being those of the level below."""
    return saved(stats.groupBy(*level).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "url-level")


def with_places(hosts: DataFrame) -> DataFrame:
    """``hosts`` (host) with their registered ``domain`` and its ``suffix``.

    User and port are no part of a name. A suffix is a name's last part, or its last two where these are as ``co.uk``; the domain has one
    part more. An address of numbers is its own domain and suffix.
    """
    name = F.regexp_replace(F.regexp_replace("host", "^.*@", ""), r":\d*$", "")
    parts = F.split(name, r"\.")
    size = F.size(parts)
    second = F.when(size > 1, F.try_element_at(parts, F.lit(-2))).isin(*SECOND_LEVEL) & (F.length(F.element_at(parts, -1)) == 2)
    last = F.when((size > 2) & second, 2).otherwise(1)
    end = lambda n: F.array_join(F.slice(parts, F.greatest(size - n + 1, F.lit(1)), n), ".")
    address = name.rlike(r"^(\d{1,3}(\.\d{1,3}){3}|\[.*\])$")
    return hosts.withColumns({"domain": F.when(address, name).otherwise(end(last + 1)), "suffix": F.when(address, name).otherwise(end(last))})


def _shrunk(stats: DataFrame, parents: DataFrame, parent: str, least: float, most: float) -> DataFrame:
    """``stats`` with the mean of their posterior, the prior's mean and weight coming from the parent.

    The weight is that of a beta distribution with the members' variance: p(1-p) / v - 1, where v is the variance of their
    rates less what sampling alone gives, all weighted by pages. Without spare variance it is ``most``. A parent without pages knows no
    more than what is above it, and hands on the weight it has itself.
    """
    above = F.col("m") if "m" in parents.columns else F.lit(most)
    joined = stats.join(parents.select(parent, F.col("mean").alias("p"), above.alias("above")), parent)
    seen = F.col("n") > 0
    rate = F.when(seen, F.col("bad") / F.when(seen, F.col("n")))
    spread = joined.groupBy(parent).agg(
        F.sum(F.when(seen, F.col("n") * F.pow(rate - F.col("p"), 2))).alias("ss"),
        F.sum("n").alias("total"),
        F.count(F.when(seen, 1)).alias("members"),
        F.first("p").alias("q"),
        F.first("above").alias("above"),
    )
    noise = F.col("q") * (1 - F.col("q"))
    extra = (F.col("ss") - F.col("members") * noise) / F.when(F.col("total") > 0, F.col("total"))
    weight = F.when(F.col("total") == 0, F.col("above")).when(extra > 0, F.least(F.greatest(noise / extra - 1, F.lit(least)), F.lit(most))).otherwise(most)
    joined = joined.join(spread.select(parent, weight.alias("m")), parent)
    return joined.withColumn("mean", (F.col("bad") + F.col("m") * F.col("p")) / (F.col("n") + F.col("m")))


def host_reputation(outcomes: DataFrame, limit: float = LIMIT, z: float = Z, least: float = LEAST, most: float = MOST, others: DataFrame | None = None) -> DataFrame:
    """(host, n, bad, mean, bound, blocked) of each host in ``outcomes`` (host, bad 0/1), one row per labelled page.

    Hosts of ``others`` (host) without outcomes have n 0 and the posterior of their domain, else of their suffix, else of the table; see
    :func:`with_places` for these. No outcomes, no rows.
    """
    hosts = outcomes.select("host", F.lit(1).cast("long").alias("n"), F.col("bad").cast("long").alias("bad"))
    if others is not None:
        none = F.lit(0).cast("long")
        hosts = hosts.unionByName(others.select("host", none.alias("n"), none.alias("bad")))
    return reputation(hosts.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), limit, z, least, most)


def reputation(hosts: DataFrame, limit: float = LIMIT, z: float = Z, least: float = LEAST, most: float = MOST) -> DataFrame:
    """:func:`host_reputation` from one row per host (host, n, bad)."""
    hosts = saved(with_places(hosts), "url-hosts")
    domains = _level(hosts, "domain", "suffix")
    suffixes = _level(domains, "suffix")
    top = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where("n > 0")
    top = top.select(F.lit(0).alias("top"), ((F.col("bad") + 1) / (F.col("n") + 2)).alias("mean"))
    suffixes = saved(_shrunk(suffixes.withColumn("top", F.lit(0)), top, "top", least, most), "url-suffixes")
    domains = saved(_shrunk(domains, suffixes, "suffix", least, most), "url-domains")
    hosts = _shrunk(hosts, domains, "domain", least, most)
    weight = F.col("n") + F.col("m") + 1
    bound = F.col("mean") - z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / weight)
    return hosts.select("host", "n", "bad", "mean", bound.alias("bound"), (bound > limit).alias("blocked"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, **limits) -> DataFrame:
    """Host, path, rule and verdict of each page (page_id, url).

    The longest rule that fits decides; without one, the host's reputation from ``outcomes`` (page_id, bad 0/1): block if it is blocked,
    else allow, as for an empty host and a null url, and for all without any outcome. A host without outcomes has the reputation above it. Several outcomes of one page count as one, bad if any is;
    those of no page or with a null in them are left out. Repeated pages are judged each; other columns are not read.
    """
    judged = split_url(pages.select("page_id", "url"))
    known = outcomes.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    # One row per host, whether any of its pages has an outcome or none has.
    hosts = judged.where("host != ''").join(known, "page_id", "left").groupBy("host")
    hosts = hosts.agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    bad = reputation(hosts, **limits).where("blocked")
    judged = judged.withColumns({"rule": _longest(rules, lambda r: r[0] + r[1]), "by_rule": _longest(rules, lambda r: r[2])})
    return judged.join(bad.select("host", "blocked"), "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"),
    )
