"""Scored and ranked host-hours."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertloom.anomaly.features import host_hour_excess, host_hour_features, model_features
from alertloom.anomaly.forest import isolation_forest
from alertloom.functions import exprs as E
from alertloom.operators.rank import global_rank
from alertloom.session import stored

KEY = ["agent", "hour"]

# Raw features shown next to a score.
SHOWN = ("alerts", "distinct_rules", "distinct_tactics", "distinct_users", "external_ips")


def same_key(prefix: str) -> Column:
    """Equal host and hour on both sides of a join, where unknown hosts are equal too."""
    return reduce(and_, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in KEY])


def malicious_host_hours(alerts: DataFrame, planted: DataFrame) -> DataFrame:
    """Distinct (agent, hour) with at least one alert known to be malicious."""
    return (
        alerts.join(planted.select("alert_id"), "alert_id", "left_semi")
        .select("agent", E.hour_start(F.col("ts")).alias("hour"))
        .distinct()
    )


def flag_malicious(rows: DataFrame, truth: DataFrame) -> DataFrame:
    known = truth.select(*[F.col(c).alias(f"_{c}") for c in KEY], F.lit(True).alias("_known"))
    return rows.join(known, same_key("_"), "left").select(
        *rows.columns, F.coalesce("_known", F.lit(False)).alias("is_malicious")
    )


def excess_table(alerts: DataFrame) -> DataFrame:
    """Model features, excess score and the shown counts per host-hour."""
    return host_hour_excess(host_hour_features(alerts), keep=SHOWN)


def anomaly_scores(
    alerts: DataFrame, trees: int = 300, sample_size: int = 256, seed: int = 42
) -> DataFrame:
    """Host-hours with `anomaly_score`. The features are written once; fit and score read the copy."""
    table = stored(excess_table(alerts))
    return isolation_forest(table, KEY, model_features(), trees, sample_size, seed)


def _by_key() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in KEY]


def _ranks(rows: DataFrame, scores: dict[str, str]) -> DataFrame:
    """Per host-hour one rank for each entry of `scores` (rank -> score), all from one sort.

    The rankings are stacked and sorted one after the other; a rank is the place behind the first row of
    its ranking. Ties go to the first (agent, hour).
    """
    stack = F.array(*[F.struct(F.lit(name).alias("_which"), F.col(score).cast("double").alias("_score")) for name, score in scores.items()])
    placed = global_rank(
        rows.select(*KEY, F.inline(stack)), [F.col("_which"), F.col("_score").desc_nulls_last(), *_by_key()], "_place"
    )
    # One row for each ranking.
    first = placed.groupBy("_which").agg(F.min("_place").alias("_first"))
    ranked = placed.join(F.broadcast(first), "_which").withColumn("_rank", F.col("_place") - F.col("_first") + 1)
    return ranked.groupBy(*KEY).agg(*[F.max(F.when(F.col("_which") == name, F.col("_rank"))).alias(name) for name in scores])


def _with_ranks(rows: DataFrame, ranks: DataFrame) -> DataFrame:
    """Ranks were found on keys and scores only; each host-hour gets its own back."""
    names = [c for c in ranks.columns if c not in rows.columns]
    own = ranks.select(*[F.col(c).alias(f"_{c}") for c in KEY], *names)
    return rows.join(own, same_key("_")).select(*rows.columns, *names)


BASELINES = {"heur_rank": "excess_score", "volume_rank": "alerts"}


def baseline_ranking(rows: DataFrame) -> DataFrame:
    """Positions by excess score and by raw volume; ties go to the first (agent, hour).

    Sorting samples its input first: pass a stored table.
    """
    return _with_ranks(rows, _ranks(rows, BASELINES))


def combined_ranking(scored: DataFrame) -> DataFrame:
    """All rankings of the scored host-hours.

    `combined_rank` is the better of the forest's and the heuristic's rank; `combined_position`
    is the place in that order, where of two equal ranks the higher score goes first. Only keys and
    scores are sorted, twice; the wide rows move once, to meet their ranks. Pass a stored table.
    """
    three = _ranks(scored, {"if_rank": "anomaly_score", **BASELINES})
    narrow = _with_ranks(scored.select(*KEY, "anomaly_score"), three)
    ranked = narrow.withColumn("combined_rank", F.least("if_rank", "heur_rank"))
    order = [F.col("combined_rank"), F.col("anomaly_score").desc_nulls_last(), *_by_key()]
    return _with_ranks(scored, global_rank(ranked, order, "combined_position"))


def host_hour_scores(
    alerts: DataFrame, planted: DataFrame, trees: int = 300, sample_size: int = 256, seed: int = 42
) -> DataFrame:
    """The complete output: every host-hour with scores, truth flag and ranks."""
    scored = anomaly_scores(alerts, trees, sample_size, seed)
    # Stored before ranking: each sort first samples its input, which would score rows twice.
    return combined_ranking(stored(flag_malicious(scored, malicious_host_hours(alerts, planted))))


def write_scores(scores: DataFrame, path: str) -> None:
    """Replace the scored table, one folder per UTC day of the hour."""
    day = E.instant(F.col("hour")).cast("date")
    scores.withColumn("day", day).hint("rebalance", F.col("day")).write.mode("overwrite").partitionBy("day").parquet(path)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("day")
