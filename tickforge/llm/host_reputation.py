"""URL filter: rules, else an empirical-Bayes reputation of the host. DataFrame functions only.

A url's host and path are cut out of it; of the rules that fit, the longest decides (of equally
long ones the first in text order). Other pages get the verdict of their host's reputation:

1. Labelled pages are counted per host (all, good ones).
2. Hosts belong to a registered domain, domains to a suffix. Good pages of a group are taken
   as beta-binomial around the mean of the group above: suffixes around the mean of all labelled
   pages and a good one, domains around their suffix, hosts around their domain. How much groups of a
   level differ (the intra-class correlation) is estimated by moments over all groups of the level;
   it gives the strength of the prior, so that a host with few labelled pages keeps its
   domain's mean and one with many its own.
3. A host is blocked when the upper bound of its posterior share of good pages (mean and
   ``Z`` deviations) is under ``MIN_GOOD``: blocking takes evidence, no labels allow.

Plan: pages are counted by (host, label key) with map-side combining and never joined one by one
with labels; the host table comes back by broadcast only within a counted number of rows,
else by a shuffled join that adaptive execution splits where a host is hot. The driver sees one row per level.

Defined results: a null url, or one without ``://``, has the host and path '' and is judged
like any other host; repeated rows each count and each get their row; a url
without a label key has no label; of several labels of one key one bad one makes it bad; very
long urls are handled whole; other columns are ignored; an empty table gives an empty result, and
without labels everything that no rule blocks is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import small_side, written

# The rules of the query (verdict, host and path).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))
# Suffixes of two labels under which names are registered.
SECOND_LEVEL = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn",
                "com.mx", "com.tr", "gov.uk", "net.au", "org.au", "org.uk")
Z = 1.645                       # 95 percent, one-sided
MIN_GOOD = 0.6
LEAST, MOST, UNKNOWN = 0.001, 0.5, 0.05   # bounds of the intra-class correlation; its value without evidence

_URL = "(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parsed(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url column."""
    u = F.coalesce(url.cast("string"), F.lit(""))
    return F.translate(F.regexp_extract(u, _URL, 1), _UPPER, _LOWER), F.regexp_extract(u, _URL, 2)


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, else NULL."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        text, verdict = F.when(fits, F.lit(rule)).otherwise(text), F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def owners(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host, without user, port and closing dots."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), "(:[0-9]*)?[.]*$", "")
    last2, last3 = F.substring_index(bare, ".", -2), F.substring_index(bare, ".", -3)
    double = last2.isin(*SECOND_LEVEL)
    return F.when(double, last3).otherwise(last2), F.when(double, last2).otherwise(F.substring_index(bare, ".", -1))


def label_counts(pages: DataFrame, labels: DataFrame, url_col: str = "url") -> DataFrame:
    """(host, n, good) of every host: its pages whose url names a labelled document in the last part of
    its path (a number, perhaps with an extension), and those of them labelled good and not toxic."""
    host, path = parsed(F.col(url_col))
    key = F.regexp_extract(path, "/([0-9]{1,18})(?:[.][a-z]+)?/?$", 1)
    seen = (pages.select(host.alias("host"), F.nullif(key, F.lit("")).cast("long").alias("label_key"))
            .groupBy("host", "label_key").agg(F.count(F.lit(1)).alias("c")))
    bad = (F.coalesce(F.col("quality"), F.lit(1)) != 1) | (F.coalesce(F.col("toxic"), F.lit(0)) != 0)
    known = (labels.filter(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
             .groupBy(F.col("doc_id").cast("long").alias("label_key")).agg(F.max(bad).alias("bad")))
    # Pages without a key stay out of the join: they would all meet in one task.
    judged = (seen.filter("label_key is not null").join(known, "label_key", "left")
              .select("host", F.when(F.col("bad").isNotNull(), F.col("c")).otherwise(0).alias("n"),
                      F.when(~F.col("bad"), F.col("c")).otherwise(0).alias("good")))
    rest = seen.filter("label_key is null").select("host", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("good"))
    return judged.unionByName(rest).groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))


def _strength(groups: DataFrame) -> float:
    """Strength of the prior of a level: its groups (n, good, around) against the means ``around`` them."""
    p, n = F.col("around"), F.col("n")
    spread = p * (1 - p)
    row = groups.agg(F.sum((F.col("good") - n * p) ** 2 - n * spread).alias("over"),
                     F.sum(n * (n - 1) * spread).alias("pairs")).first()
    rho = row["over"] / row["pairs"] if row["pairs"] else UNKNOWN
    return 1 / min(max(rho, LEAST), MOST) - 1


def _posterior(groups: DataFrame, strength: float) -> DataFrame:
    """``groups`` with the mean and weight of their posterior."""
    weight = F.col("n") + strength
    return groups.withColumn("mean", (F.col("good") + F.col("around") * strength) / weight).withColumn("weight", weight)


def reputation(counts: DataFrame) -> DataFrame:
    """(host, n, good, mean, weight) of every host in ``counts`` (host, n, good): its
    posterior share of good pages and the pages it rests on, labelled or of the prior."""
    domain, suffix = owners(F.col("host"))
    hosts = written(counts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "good"), "host-counts")
    sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    domains = written(hosts.groupBy("domain", "suffix").agg(*sums), "domain-counts")
    suffixes = written(domains.groupBy("suffix").agg(*sums), "suffix-counts")
    total = suffixes.agg(*sums).first()
    level = suffixes.withColumn("around", F.lit(((total["good"] or 0) + 1) / ((total["n"] or 0) + 1)))
    for below, on in ((domains, "suffix"), (hosts, "domain")):
        above = written(_posterior(level, _strength(level)).select(on, F.col("mean").alias("around")), f"{on}-means")
        level = below.join(small_side(above), on)
    return _posterior(level, _strength(level)).select("host", "n", "good", "mean", "weight")


def judge(pages: DataFrame, counts: DataFrame, rules=RULES, min_good: float = MIN_GOOD, z: float = Z,
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, n_labelled, good_bound) of every page. ``counts`` (host, n,
    good) holds the labelled pages of every host of ``pages``; ``good_bound`` is the upper bound of the
    posterior share of good pages, to six digits."""
    bound = F.col("mean") + z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    known = written(reputation(counts).select("host", F.col("n").alias("n_labelled"),
                                              F.round(F.least(bound, F.lit(1.0)), 6).alias("good_bound")), "reputations")
    host, path = parsed(F.col(url_col))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, says = fitting_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("good_bound") < min_good, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(small_side(known), "host").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(says, own).alias("verdict"), "n_labelled", "good_bound")


def filter_pages(pages: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``judge`` with the counts of ``labels``."""
    return judge(pages, label_counts(pages, labels), **options)
