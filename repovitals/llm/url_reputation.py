"""URL filter by rules, and for other urls by the reputation of their host.

Pages with known outcomes give each host a share of bad pages. The share is shrunk by beta-binomial
priors: a host's prior is centred on its registered domain's share, that one's on its suffix's, that
one's on the share of all. How strongly, is estimated at each level from how much the shares of its
members scatter beyond chance. A host is blocked where even the lower bound of its posterior share of
bad pages is above a limit. All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import stored, workspace

ALLOW, BLOCK = "allow", "block"
#: A host goes if its share of bad pages exceeds the limit by so many posterior standard deviations.
MAX_BAD = 0.5
DEVIATIONS = 1.645
#: Suffixes of two labels under which names are registered; all other suffixes are the last label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.jp", "ne.jp", "co.nz", "com.br", "co.in")
#: Hosts that are numbers, or in brackets, are no names: each is its own domain, and all share one suffix.
ADDRESS = r"(?s)^([0-9.]+|\[.*)$"
ADDRESSES = "[]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Limits of the estimated correlation within a group: neither no scatter at all nor nothing but it.
_LEAST_SCATTER, _MOST_SCATTER = 0.001, 0.9


def url_host(url: Column) -> Column:
    """What stands between the first :// and the next / ? # or the end, with A-Z lower-cased; else ''."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ? # or the end; '' if there is no ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _name(host: Column) -> Column:
    """A host without user, port and final dots."""
    return F.regexp_replace(F.regexp_extract(host, r"(?s)^(?:[^@]*@)?(\[[^\]]*\]|[^:@]*)", 1), r"\.+$", "")


def suffix_of(name: Column) -> Column:
    last_two = F.substring_index(name, ".", -2)
    named = F.when(last_two.isin(*TWO_LABEL_SUFFIXES), last_two).otherwise(F.substring_index(name, ".", -1))
    return F.when(name.rlike(ADDRESS), ADDRESSES).otherwise(named)


def domain_of(name: Column) -> Column:
    """The suffix and one label before it; an address as a whole."""
    last_two = F.substring_index(name, ".", -2)
    named = F.when(last_two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(name, ".", -3)).otherwise(last_two)
    return F.when(name.rlike(ADDRESS), name).otherwise(named)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule (verdict, host, path) that fits, as struct(rule, verdict), or NULL."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        named = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def _strength(groups: DataFrame) -> Column:
    """How many pages the prior counts for, from the scatter of groups (n, bad, mean) around their means."""
    spread = F.col("mean") * (1 - F.col("mean"))
    beyond = F.sum(F.pow(F.col("bad") - F.col("n") * F.col("mean"), 2) - F.col("n") * spread)
    chance = F.sum(F.col("n") * (F.col("n") - 1) * spread)
    scatter = F.coalesce(F.try_divide(beyond, chance), F.lit(_MOST_SCATTER))
    bounded = F.greatest(F.lit(_LEAST_SCATTER), F.least(F.lit(_MOST_SCATTER), scatter))
    return groups.agg((1 / bounded - 1).alias("strength")).scalar()


def _shrunk(level: DataFrame, key: str, parents: DataFrame | None, parent: str | None) -> DataFrame:
    """Rows (key, mean): the posterior mean share of each group, given its parent's."""
    if parents is None:
        whole = level.agg(((F.sum("bad") + 0.5) / (F.sum("n") + 1)).alias("mean")).scalar()
        met = level.withColumn("mean", F.coalesce(whole, F.lit(0.5)))
    else:
        met = level.join(parents, parent)
    strength = _strength(met.where("n > 0"))
    return met.select(key, ((F.col("bad") + strength * F.col("mean")) / (F.col("n") + strength)).alias("mean"))


def host_reputations(outcomes: DataFrame) -> DataFrame:
    """Rows (host, n_labelled, n_bad, bad_share, bad_bound) of all hosts in outcomes (host, bad).

    bad: 1, 0, or NULL where the outcome is not known. bad_share is the posterior mean; bad_bound lies
    DEVIATIONS posterior standard deviations below it. Each level is stored, so that its strength and its
    members' means are made from rows that are there, not from the outcomes again.
    """
    place = workspace(outcomes.sparkSession)
    hosts = outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad")
    )
    name = _name(F.col("host"))
    hosts = hosts.select("host", "n", "bad", domain_of(name).alias("domain"), suffix_of(name).alias("suffix"))
    hosts = stored(hosts, f"{place}/hosts")
    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = stored(hosts.groupBy("domain", "suffix").agg(*sums), f"{place}/domains")
    suffixes = stored(domains.groupBy("suffix").agg(*sums), f"{place}/suffixes")
    by_suffix = stored(_shrunk(suffixes, "suffix", None, None), f"{place}/by_suffix")
    by_domain = stored(_shrunk(domains, "domain", by_suffix, "suffix"), f"{place}/by_domain")
    met = stored(hosts.join(by_domain, "domain"), f"{place}/met")
    strength = _strength(met.where("n > 0"))
    a = F.col("bad") + strength * F.col("mean")
    b = F.col("n") - F.col("bad") + strength * (1 - F.col("mean"))
    share = F.col("a") / (F.col("a") + F.col("b"))
    deviation = F.sqrt(share * (1 - share) / (F.col("a") + F.col("b") + 1))
    return met.select("host", "n", "bad", a.alias("a"), b.alias("b")).select(
        "host",
        F.col("n").alias("n_labelled"),
        F.col("bad").alias("n_bad"),
        share.alias("bad_share"),
        (share - DEVIATIONS * deviation).alias("bad_bound"),
    )


def judge_urls(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, bad_share, bad_bound), one per row of pages (page_id, url).

    labels: (page_id, bad) with bad 1 or 0; a page labelled more than once is bad if any label says so.
    A rule (verdict, host, path) fits its host and all hosts below it where the path starts with the
    rule's; the longest wins over reputation. A NULL url, or one without ://, has an empty host and
    path, and such pages share one reputation. Without labels every share is one half and its bound
    below the limit, so hosts without a rule are allowed. Other columns are not read.
    """
    known = labels.where("bad is not null").groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    urls = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    outcomes = urls.select("page_id", "host").join(known, "page_id", "left")
    judged = urls.join(host_reputations(outcomes.select("host", "bad")), "host")
    reputation = F.when(F.col("bad_bound") > MAX_BAD, BLOCK).otherwise(ALLOW)
    judged = judged.withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    return judged.select(
        "page_id", "host", "path", "found.rule",
        F.coalesce("found.verdict", reputation).alias("verdict"), "bad_share", "bad_bound",
    )
