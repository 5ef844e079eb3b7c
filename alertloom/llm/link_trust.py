"""URL filters: rules by host and path, and trust walked over the links between hosts for all that no rule fits.

A rule is a host with a path, such as `example.com/en/`. It fits the urls of its host and of all subdomains whose
path begins with the rule's; the longest that fits decides. What rules decide makes seeds: a host is trusted by
the share of its pages that rules allow and distrusted by the share that they block. Personalised PageRank carries
trust along the links from host to host, and distrust against them, from a blocked host to those that link
to it. Every step passes on 85 percent of what came in the step before, by the number of links. A host
is blocked if its distrust is above its trust and reaches what a host has by itself of which a quarter
is blocked.

Scores are whole numbers, so the order of the sums does not matter. Each step is written, which cuts the lineage;
it holds at most one row for each host and direction. Pages are only read to judge urls and to count links, pairs
of hosts are summed in the tasks first. Only DataFrame functions are used.

Defined cases: a null url, or one without `://`, has an empty host and path; no rule fits it, it is not linked with
anything and is allowed. Of rules of equal length that fit, the one with the longer host decides, then one that blocks.
A null html has no links. Links of a host to itself are left out. Repeated rows are judged each, and count each. An
empty table gives no rows. Columns other than page_id, url and html are ignored. A step keeps whole parts of
10**-9 of a host's own score.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertloom.session import stored

# Verdict and rule.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
UNIT = 10**9
# Percent of a score that is passed on, and the share of blocked pages that blocks a host by itself.
PASSED, BLOCKED = 85, 25
# What is left to pass on after these steps is under a hundredth.
STEPS = 30
SALTS = 16

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)<a[\t\n\f\r ][^<>]*?href[\t\n\f\r ]*=[\t\n\f\r ]*["']?[\t\n\f\r ]*(?:[a-z][a-z0-9+.-]*:)?//([^"'/?#<>\t\n\f\r ]*)"""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rules_table(spark: SparkSession, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, rule string")


def host_of(url: str) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Per host: the rules of it and of its parents, the one that decides first. Bounded by the rules, not by the pages."""
    own = F.regexp_extract("rule", "^[^/]*", 0)
    cut = rules.select(own.alias("parent"), F.regexp_replace("rule", "^[^/]*", "").alias("start"), "rule", "verdict")
    # Only as many labels as a rule has are taken off a host, however long it is.
    most = cut.agg(F.max(F.size(F.split("parent", r"\.")))).first()[0] or 0
    labels = F.split("host", r"\.")
    tails = F.transform(
        F.sequence(F.lit(1), F.least(F.size(labels), F.lit(max(most, 1)))), lambda n: F.array_join(F.slice(labels, -n, n), ".")
    )
    met = hosts.select("host", F.explode(tails).alias("parent")).join(cut, "parent")
    order = F.struct(
        (-F.length("rule")).alias("length"), (-F.length("parent")).alias("host"), F.col("verdict") != "block", "start", "rule", "verdict"
    )
    return met.groupBy("host").agg(F.array_sort(F.collect_set(order)).alias("rules"))


def with_hosts(urls: DataFrame, facts: DataFrame) -> DataFrame:
    """`urls` with what is known of their hosts; a host with very many urls is dealt out by a salt."""
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    salted = urls.withColumn("salt", F.pmod(F.xxhash64("page_id", "path"), F.lit(SALTS)))
    return salted.join(facts.withColumn("salt", F.explode(salts)), ["host", "salt"], "left").drop("salt")


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Per page: page_id, host, path, and the rule that decides with its verdict, if any."""
    urls = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    known = rules_of_hosts(urls.select("host").distinct(), rules)
    first = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["start"])), F.lit(0))
    found = with_hosts(urls, known).withColumn("found", first)
    return found.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("verdict"))


def host_links(pages: DataFrame) -> DataFrame:
    """(source, target, links) for every two hosts of which one links to the other."""
    linked = pages.select(host_of("url").alias("source"), F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("to"))
    pairs = linked.select("source", F.translate("to", _UPPER, _LOWER).alias("target"))
    return pairs.where("source != '' and target != '' and source != target").groupBy("source", "target").agg(F.count("*").alias("links"))


def spread(links: DataFrame, seeds: DataFrame, passed: int = PASSED, steps: int = STEPS) -> DataFrame:
    """Per host reached: trust and distrust.

    `seeds` has host, trust and distrust up to UNIT. A host with very many links is a skewed key of narrow rows on
    one side of the join, which adaptive execution splits; what arrives at a host is summed in the tasks first.
    """
    there = links.select(F.lit(True).alias("forward"), F.col("source").alias("a"), F.col("target").alias("b"), "links")
    back = links.select(F.lit(False).alias("forward"), F.col("target").alias("a"), F.col("source").alias("b"), "links")
    every = there.unionByName(back)
    totals = every.groupBy("forward", "a").agg(F.sum("links").alias("total"))
    ways = stored(every.join(totals, ["forward", "a"]))
    sides = [
        F.struct(F.lit(forward).alias("forward"), F.expr(f"{c} * {100 - passed} div 100").alias("score"))
        for forward, c in ((True, "trust"), (False, "distrust"))
    ]
    now = stored(seeds.select("host", F.inline(F.array(*sides))).where("score > 0"))
    done = [now]
    # Decimals hold the product of any score and any number of links.
    share = f"cast(score as decimal(19, 0)) * cast(links as decimal(19, 0)) div total * {passed} div 100"
    for _ in range(steps):
        arrived = ways.join(now.withColumnRenamed("host", "a"), ["forward", "a"])
        sums = arrived.groupBy(F.col("b").alias("host"), "forward").agg(F.sum(F.expr(share)).alias("score"))
        now = stored(sums.where("score > 0"))
        if now.isEmpty():
            break
        done.append(now)
    score = F.sum(F.when(F.col("forward"), F.col("score")).otherwise(0)).alias("trust")
    against = F.sum(F.when(F.col("forward"), 0).otherwise(F.col("score"))).alias("distrust")
    return reduce(DataFrame.unionByName, done).groupBy("host").agg(score, against)


def filter_urls(
    pages: DataFrame, rules: DataFrame | None = None, passed: int = PASSED, blocked: int = BLOCKED, steps: int = STEPS
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and its host's trust and distrust."""
    rules = rules_table(pages.sparkSession) if rules is None else rules
    judged = stored(judge_urls(pages, rules))
    counted = judged.where("host != ''").groupBy("host").agg(
        F.count("*").alias("pages"),
        F.count_if(F.col("verdict") == "allow").alias("allowed"),
        F.count_if(F.col("verdict") == "block").alias("blocked"),
    )
    share = {c: F.expr(f"{UNIT}L * {n} div pages") for c, n in (("trust", "allowed"), ("distrust", "blocked"))}
    seeds = counted.where("allowed + blocked > 0").select("host", *(v.alias(k) for k, v in share.items()))
    scores = spread(host_links(pages), seeds, passed, steps)
    least = UNIT * (100 - passed) // 100 * blocked // 100
    bad = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= least)
    verdict = F.coalesce("verdict", F.when(bad, "block").otherwise("allow"))
    zero = F.lit(0).cast("long")
    return with_hosts(judged, scores).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), F.coalesce("trust", zero).alias("trust"),
        F.coalesce("distrust", zero).alias("distrust"),
    )
