"""How well the rankings find the known incidents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.anomaly.features import model_features
from alertloom.anomaly.ranking import same_key
from alertloom.functions import exprs as E

METHODS = {
    "isolation_forest": "if_rank",
    "excess_heuristic": "heur_rank",
    "raw_volume": "volume_rank",
    "combined": "combined_position",
}
BASELINES = {m: METHODS[m] for m in ("excess_heuristic", "raw_volume")}
KS = (10, 25, 50, 100)


def precision_recall_at_k(
    ranked: DataFrame, ks: Sequence[int] = KS, methods: Mapping[str, str] = METHODS
) -> DataFrame:
    """(method, k, hits, precision, recall) for every method and k, in one pass."""
    cells = [(m, rank, k) for m, rank in methods.items() for k in ks]
    counted = ranked.agg(
        F.count_if("is_malicious").alias("known"),
        *[
            F.count_if(F.col("is_malicious") & (F.col(rank) <= k)).alias(f"{m}_{k}")
            for m, rank, k in cells
        ],
    )
    rows = [
        F.struct(F.lit(m).alias("method"), F.lit(k).alias("k"), F.col(f"{m}_{k}").alias("hits"))
        for m, _, k in cells
    ]
    return counted.select("known", F.inline(F.array(*rows))).select(
        "method",
        "k",
        "hits",
        E.ratio(F.col("hits"), F.col("k")).alias("precision"),
        E.ratio(F.col("hits"), F.col("known")).alias("recall"),
    )


def incident_ranks(
    ranked: DataFrame, incidents: DataFrame, methods: Mapping[str, str] = METHODS
) -> DataFrame:
    """Rank of each incident's first host-hour; NULL where that host-hour does not exist."""
    columns = [F.col(rank).alias(m) for m, rank in methods.items()]
    named = incidents.select("agent", "hour").distinct().toDF("_agent", "_hour")
    hits = ranked.join(named, same_key("_"), "left_semi")
    found = hits.select(F.col("agent").alias("_agent"), F.col("hour").alias("_hour"), *columns)
    return incidents.join(found, same_key("_"), "left").select("incident", "agent", "hour", *methods)


def top_anomalies(ranked: DataFrame, limit: int = 15, rank: str = "if_rank", score: str = "anomaly_score") -> DataFrame:
    """The most anomalous host-hours with what was seen in them."""
    return (
        ranked.filter(F.col(rank) <= limit)
        .select(
            F.col(rank).alias("rank"),
            "agent",
            F.date_format("hour", "yyyy-MM-dd HH:00").alias("hour"),
            "alerts",
            F.col("distinct_rules").alias("rules"),
            F.col("distinct_tactics").alias("tactics"),
            F.col("distinct_users").alias("users"),
            "external_ips",
            "max_level",
            F.round(score, 3).alias("score"),
            "is_malicious",
        )
        .orderBy("rank")
    )


def feature_importance(
    ranked: DataFrame, top: int = 25, limit: int = 6, rank: str = "if_rank"
) -> DataFrame:
    """Features whose mean in the top rows is furthest from the overall mean, in deviations."""
    features = model_features()
    head = F.col(rank) <= top
    stats = ranked.agg(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                F.abs(
                    E.ratio(F.avg(F.when(head, F.col(f))) - F.avg(f), F.stddev_samp(f))
                ).alias("z"),
            ).alias(f)
            for f in features
        ]
    )
    return (
        stats.select(F.inline(F.array(*features)))
        .select("feature", F.round("z", 1).alias("abs_z"), "z")
        .orderBy(F.col("z").desc_nulls_last(), "feature")
        .limit(limit)
        .drop("z")
    )


def score_histogram(
    rows: DataFrame, score: str = "anomaly_score", benign_bins: int = 80, malicious_bins: int = 40
) -> DataFrame:
    """Equal-width bins over each class's own range, empty bins included.

    The last bin includes its upper edge; a class with one value spans that value plus and
    minus one half.
    """
    bins = F.when(F.col("is_malicious"), malicious_bins).otherwise(benign_bins)
    ranges = (
        rows.groupBy("is_malicious")
        .agg(F.min(score).alias("low"), F.max(score).alias("high"))
        .filter(F.col("low").isNotNull())
        .withColumn("flat", F.col("low") == F.col("high"))
        .select(
            "is_malicious",
            bins.alias("bins"),
            F.when(F.col("flat"), F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
            F.when(F.col("flat"), F.col("high") + 0.5).otherwise(F.col("high")).alias("high"),
        )
    )
    part = (F.col(score) - F.col("low")) / (F.col("high") - F.col("low"))
    bin_of = F.least(F.floor(part * F.col("bins")).cast("int"), F.col("bins") - 1)
    # Two rows of ranges, one per class.
    counted = (
        rows.filter(F.col(score).isNotNull())
        .join(F.broadcast(ranges), "is_malicious")
        .groupBy("is_malicious", bin_of.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("high") - F.col("low")) / F.col("bins")
    grid = ranges.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin")
    )
    return grid.join(counted, ["is_malicious", "bin"], "left").select(
        "is_malicious",
        "bin",
        F.round(F.col("low") + F.col("bin") * width, 6).alias("bin_start"),
        F.round(F.col("low") + (F.col("bin") + 1) * width, 6).alias("bin_end"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("host_hours"),
    ).orderBy("is_malicious", "bin")


def scoring_summary(rows: DataFrame) -> DataFrame:
    """Host-hours scored, hosts, host-hours with a malicious alert and their percentage."""
    n = F.count(F.lit(1))
    known = F.count_if("is_malicious")
    return rows.agg(
        n.alias("host_hours"),
        F.count_distinct("agent").alias("hosts"),
        known.alias("malicious_host_hours"),
        E.percent(known, n, 2).alias("malicious_pct"),
    )
