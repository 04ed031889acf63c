"""URL filter: longest-match rules, then empirical-Bayes host reputation. DataFrame functions only.

Labelled page outcomes (bad: quality 0 or toxic 1) are counted per host, registered domain
and suffix. Each level is a beta-binomial whose prior mean is the posterior mean of the
level above it, and whose prior strength is estimated from the spread between that level's
groups (method of moments). A host is blocked when its posterior says that the bad rate is over
``max_bad`` with a probability of at least ``sure``: the exact beta tail, by quadrature.

Levels leave out user info, port and trailing dot. A suffix is the last label, or two of them
where a label of ``SECOND_LEVEL`` stands before a country's two letters; the registered domain
is one label more. A numeric address is its own registered domain, all in one suffix.

Edge cases: null urls and urls without ``://`` have empty host and path; labels with a null
outcome or without a page are ignored; a host without labels takes its domain's posterior,
then its suffix's, then that of all labels (a flat prior where there are none: allow). Repeated
rows are each judged and each counted; ids are compared as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored

#: (verdict, host + path prefix)
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: The bad rate that blocks, and how sure the posterior must be of it.
MAX_BAD, SURE = 0.5, 0.95
#: Blocked hosts that are broadcast; more are joined by a shuffle.
BROADCAST_HOSTS = 200_000
#: Labels that make a suffix together with a country's two letters.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gob", "gov", "mil", "ne", "net", "or", "org")
#: Points of the quadrature on either side of max_bad, and deviations that it reaches from the mode.
POINTS, REACH, FARTHEST = 64, 12.0, 600.0
#: Limits of the estimated prior strengths.
WEAKEST, STRONGEST = 1.0, 1000.0


def url_host(url: Column) -> Column:
    rest = F.expr("substr(url, instr(url, '://') + 3)")
    return F.when(F.instr(url, "://") > 0, ascii_lower(F.regexp_extract(rest, r"\A[^/?#]*", 0))).otherwise("")


def url_path(url: Column) -> Column:
    rest = F.expr("substr(url, instr(url, '://') + 3)")
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)).otherwise("")


def match_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; nulls where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


_SUFFIX = f"(?:(?:{'|'.join(SECOND_LEVEL)})[.][a-z][a-z]|[^.]*)"
#: Patterns that Spark and other engines read alike.
HOST_CLUTTER, ADDRESS = r"\A[^@]*@|:[0-9]*\z|[.]\z|[.]:[0-9]*\z", r"\A([0-9]{1,3}([.][0-9]{1,3}){3}|\[.*\])\z"
SUFFIX, DOMAIN, ADDRESSES = rf"(?:\A|[.])({_SUFFIX})\z", rf"(?:\A|[.])([^.]+[.]{_SUFFIX})\z", "(address)"


def levels(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host."""
    bare = F.regexp_replace(host, HOST_CLUTTER, "")
    domain = F.regexp_extract(bare, DOMAIN, 1)
    domain = F.when(bare.rlike(ADDRESS) | (domain == ""), bare).otherwise(domain)
    return domain, F.when(bare.rlike(ADDRESS), ADDRESSES).otherwise(F.regexp_extract(bare, SUFFIX, 1))


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """host, n, bad: the labelled pages of each host, counted before anything is shuffled by host."""
    known_bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1)
    bad = known_bad.when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    known = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad")).where("bad is not null and page_id is not null")
    seen = pages.select("page_id", url_host(F.col("url")).alias("host")).join(known, "page_id")
    return seen.groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))


def strength(groups: DataFrame) -> float:
    """Prior strength a + b of a beta-binomial over groups (n, bad), from its moments."""
    r = groups.where("n > 0").agg(
        F.count("*").alias("k"), F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("bb"),
    ).first()
    if not r["k"] or r["k"] < 2 or not 0 < r["bad"] < r["n"]:
        return STRONGEST
    p, k, n = r["bad"] / r["n"], r["k"], r["n"]
    between = r["bb"] - n * p * p  # sum of n (p_i - p)^2
    rho = (between - (k - 1) * p * (1 - p)) / (p * (1 - p) * ((n - r["nn"] / n) - (k - 1))) if n - r["nn"] / n > k - 1 else 0
    return min(STRONGEST, max(WEAKEST, 1 / rho - 1)) if rho > 0 else STRONGEST


def reputation(stats: DataFrame) -> DataFrame:
    """From outcomes(), a table: one row per host, domain and suffix with labels, and one of all.

    Columns: level (host, domain, suffix, all), name, a, b: the beta posterior of the bad rate.
    """
    domain, suffix = levels(F.col("host"))
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    h = stats.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad")
    d = stored(h.groupBy("domain", "suffix").agg(*sums), "domains")
    s = stored(d.groupBy("suffix").agg(*sums), "suffixes")
    total = s.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    whole = stats.sparkSession.createDataFrame([("all", "", total["bad"] + 1.0, total["n"] - total["bad"] + 1.0)],
        "level string, name string, a double, b double")
    rate = (total["bad"] + 1) / (total["n"] + 2)
    ms, md, mh = strength(s), strength(d), strength(h)

    def posterior(df: DataFrame, mean, m: float) -> DataFrame:
        return df.withColumn("a", F.col("bad") + m * mean).withColumn("b", F.col("n") - F.col("bad") + m * (1 - mean))

    s = posterior(s, F.lit(rate), ms)
    up = lambda df, key: df.select(F.col(key), (F.col("a") / (F.col("a") + F.col("b"))).alias("up"))
    d = posterior(d.join(up(s, "suffix"), "suffix"), F.col("up"), md)
    h = posterior(h.join(up(d, "domain"), "domain"), F.col("up"), mh)
    as_level = lambda df, key: df.select(F.lit(key).alias("level"), F.col(key).alias("name"), "a", "b")
    return as_level(h, "host").unionAll(as_level(d, "domain")).unionAll(as_level(s, "suffix")).unionAll(whole)


def below(a: Column, b: Column, x: float) -> Column:
    """Probability that a beta(a, b) rate is at most x: midpoint sums over the log odds u on both sides of x.

    There the density is exp(a u) / (1 + exp(u))^(a + b), smooth however small a or b is.
    """
    cut, mode, width = math.log(x / (1 - x)), F.ln(a / b), F.sqrt(1 / a + 1 / b)
    low, high = F.greatest(mode - REACH * width, F.lit(-FARTHEST)), F.least(mode + REACH * width, F.lit(FARTHEST))
    height = lambda u: a * u - (a + b) * F.log1p(F.exp(u))

    def area(start: Column, end: Column) -> Column:
        step = (end - start) / POINTS
        at = lambda i: start + (i + 0.5) * step
        points = F.sequence(F.lit(0), F.lit(POINTS - 1))
        return F.aggregate(points, F.lit(0.0), lambda acc, i: acc + F.exp(height(at(i)) - height(mode))) * step

    left, right = area(low, F.lit(cut)), area(F.lit(cut), high)
    return F.when(low >= cut, 0.0).when(high <= cut, 1.0).otherwise(left / (left + right))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, max_bad: float = MAX_BAD, sure: float = SURE) -> DataFrame:
    """pages' page_id with host, path, rule, verdict: the longest rule's, else the reputation's."""
    rep = reputation(stored(outcomes(pages, labels), "outcomes"))
    rep = rep.select("level", "name", (below(F.col("a"), F.col("b"), max_bad) <= 1 - sure).alias("bad"))
    rep = stored(rep, "reputation")
    of = lambda level: rep.where(F.col("level") == level).select(F.col("name").alias(level),
        F.col("bad").alias(f"{level}_bad"))
    overall = rep.where("level = 'all'").first()["bad"]
    host, path = F.col("host"), F.col("path")
    rule, verdict = match_rule(host, path, rules)
    domain, suffix = levels(host)
    seen = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    # one row per distinct host is judged, and only blocked hosts meet the pages: a hot host is not shuffled
    hosts = seen.select("host").distinct().select("host", domain.alias("domain"), suffix.alias("suffix"))
    hosts = hosts.join(of("host"), "host", "left").join(of("domain"), "domain", "left").join(of("suffix"), "suffix", "left")
    blocked = hosts.where(F.coalesce("host_bad", "domain_bad", "suffix_bad", F.lit(overall))).select(F.col("host").alias("blocked"))
    blocked = stored(blocked, "blocked")
    if blocked.count() <= BROADCAST_HOSTS:
        blocked = F.broadcast(blocked)
    out = seen.join(blocked, F.col("host") == F.col("blocked"), "left")
    reputed = F.when(F.col("blocked").isNotNull(), "block").otherwise("allow")
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, reputed).alias("verdict"))
