"""Every operator as a named query over the derived tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertloom import reports
from alertloom import schemas as S
from alertloom.anomaly import evaluate, features, forest, incremental, ranking
from alertloom.functions import exprs as E
from alertloom.operators import chains
from alertloom.operators.joins import escalated_alerts, latest_triage, repeated_triage, untriaged_alerts
from alertloom.plans import bursts, coverage, latency, members, tuning, volume
from alertloom.session import scratch_dir, stored
from alertloom.sources import raw, sketches, tables
from alertloom.streaming import hourly
from alertloom.verification import derived

Query = Callable[[SparkSession, str], DataFrame]

# The derived rules have about a fifth of the default volume.
MIN_ALERTS = 1000


def _on_alerts(fn: Callable[..., DataFrame], **params) -> Query:
    return lambda spark, sf: fn(derived.alerts(spark, sf), **params)


def _on_both(fn: Callable[..., DataFrame], **params) -> Query:
    return lambda spark, sf: fn(derived.alerts(spark, sf), derived.triage(spark, sf), **params)


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _load_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Writes the derived alerts as JSON lines and loads them from there."""
    path = _scratch(spark, "raw-alerts")
    derived.raw_alert_lines(spark, sf).write.text(path)
    return raw.load_alerts(spark, path)


def _load_triage(spark: SparkSession, sf: str) -> DataFrame:
    """Writes the derived triage log as CSV and loads it from there."""
    path = _scratch(spark, "raw-triage")
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    derived.triage(spark, sf).withColumns(
        {c: F.date_format(c, stamp) for c in ("opened_at", "closed_at")}
    ).write.option("header", True).csv(path)
    return raw.load_triage(spark, path)


def _load_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Stores both tables, which counts their rows on the way."""
    a, t = _scratch(spark, "alerts"), _scratch(spark, "triage")
    return tables.observed_counts(
        spark,
        alerts=tables.write_alerts(derived.alerts(spark, sf), a),
        triage=tables.write_triage(derived.triage(spark, sf), t),
    )


def _truth_path(spark: SparkSession, sf: str) -> str:
    path = _scratch(spark, "truth")
    # A file for each document: the loader reads files whole.
    derived.truth_document(spark, sf).write.option("maxRecordsPerFile", 1).text(path)
    return path


def _volume_of_days(spark: SparkSession, sf: str) -> DataFrame:
    """Stores the alerts by day and reads some days, from and to the middle of one."""
    path = _scratch(spark, "alerts")
    tables.write_alerts(derived.alerts(spark, sf), path)
    return volume.daily_volume_by_severity(tables.read_alerts(spark, path, *derived.DAYS))


def _replaced_days(spark: SparkSession, sf: str) -> DataFrame:
    """Stores all alerts, then some days again and once more with their severe alerts alone."""
    path, alerts = _scratch(spark, "alerts"), derived.alerts(spark, sf)
    tables.write_alerts(alerts, path)
    span = [d.date() for d in derived.DAYS]
    for _ in range(2):
        tables.replace_days(alerts.where(F.col("level") >= S.floor_of("high")), path, *span)
    return volume.daily_volume_by_severity(tables.read_alerts(spark, path))


def _triage_of_days(spark: SparkSession, sf: str) -> DataFrame:
    """Stores the triage log by the day of opening, one half of the time after the other, and reads some days."""
    path, triage = _scratch(spark, "triage"), derived.triage(spark, sf)
    middle = derived.DAYS[1].date()
    tables.replace_days(triage, path, dt.date.min, middle, "opened_at")
    tables.replace_days(triage, path, middle + dt.timedelta(days=1), dt.date.max, "opened_at")
    return tables.read_triage_days(spark, path, *derived.DAYS)


def _streamed(spark: SparkSession, sf: str) -> DataFrame:
    """Counts the alerts as lines that arrive in two lots, the second with a fifth of all lines once more."""
    lines, counts, checkpoint = (_scratch(spark, n) for n in ("stream", "hourly", "progress"))
    raw_lines = derived.raw_alert_lines(spark, sf)
    number = F.get_json_object("value", "$.id").cast("bigint")
    for lot in (number % 2 == 0, (number % 2 == 1) | (number % 5 == 0)):
        raw_lines.where(lot).write.mode("append").text(lines)
        # The lots cover the same time, so that a delay as long as all of it loses no line.
        stream = hourly.alert_stream(spark, lines)
        hourly.keep_hourly_severity(stream, counts, checkpoint, delay="3660 days").awaitTermination()
    return hourly.read_hourly_severity(spark, counts)


def _scores_of_stored_forest(spark: SparkSession, sf: str) -> DataFrame:
    """Fits a forest, stores it, and scores the host-hours by what was stored."""
    path = _scratch(spark, "forest")
    names = features.model_features()
    table = stored(ranking.excess_table(derived.alerts(spark, sf)))
    nodes = forest.fit(table, ranking.KEY, names)
    forest.write_model(nodes, path, names)
    return forest.score_with_model(table, path).select("agent", "hour", "anomaly_score")


def _source_breadth(spark: SparkSession, sf: str) -> DataFrame:
    """Stores the daily sketches of the sources and merges those of some days."""
    path = _scratch(spark, "source-sketches")
    sketches.write_days(sketches.daily_source_sketches(derived.alerts(spark, sf)), path)
    first, last = (d.date() for d in derived.DAYS)
    return sketches.approx_source_breadth(sketches.read_days(spark, path, first, last).drop("users"))


def _time_to_open(spark: SparkSession, sf: str) -> DataFrame:
    """Stores the daily sketches of the latencies, merges all days, and holds the answers against the exact ranks."""
    path = _scratch(spark, "latency-sketches")
    a, t = derived.alerts(spark, sf), derived.triage(spark, sf)
    sketches.write_days(sketches.daily_latency_sketches(a, t), path)
    wanted = {"p50": 0.5, "p90": 0.9}
    # Written: the answers of a sketch may differ from run to run, within its error.
    found = stored(sketches.approx_time_to_open(sketches.read_days(spark, path), wanted))
    bounds = sketches.rank_bounds(found, a, t, wanted)
    near = [F.lit(p).between(F.col(f"{n}_low") - 0.01, F.col(f"{n}_high") + 0.01).alias(f"{n}_within_1pct") for n, p in wanted.items()]
    return bounds.select("severity", "actions", *near)


def _report_results(spark: SparkSession, sf: str) -> DataFrame:
    """Runs all reports, writes them, reads them back, and counts their rows, columns and preview."""
    folder = _scratch(spark, "reports")
    results = reports.run(derived.alerts(spark, sf), derived.triage(spark, sf))
    reports.write_results(results, folder)
    counts = []
    for report in reports.REPORTS:
        written = spark.read.schema(results[report.name].schema).parquet(f"{folder}/{report.name}")
        shown, rows = reports.preview(written)
        counts.append((report.number, report.name, rows, len(written.columns), len(shown)))
    return spark.createDataFrame(counts, "number string, report string, rows long, columns int, previewed int")


def _written_report(name: str) -> Query:
    """A report written by number together with another one, and read back."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        folder = _scratch(spark, "reports")
        chosen = [reports.select([name])[0].number, "06"]
        results = reports.run(derived.alerts(spark, sf), derived.triage(spark, sf), chosen)
        reports.write_results(results, folder)
        return spark.read.schema(results[name].schema).parquet(f"{folder}/{name}")

    return query


def _stored_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Writes the scored table and reads it back."""
    path = _scratch(spark, "scores")
    ranking.write_scores(_ranked(spark, sf), path)
    return ranking.read_scores(spark, path)


def _features(spark: SparkSession, sf: str) -> DataFrame:
    return features.host_hour_features(derived.alerts(spark, sf))


def _features_by_day(spark: SparkSession, sf: str) -> DataFrame:
    """Adds the alerts in two parts, the second from the middle of a day on, and takes the features from what is stored."""
    path, alerts = _scratch(spark, "seen"), derived.alerts(spark, sf)
    earlier = E.instant(F.col("ts")) < E.instant(F.lit(str(derived.DAYS[1])).cast("timestamp_ntz"))
    for part in (earlier, ~earlier):
        incremental.add_alerts(spark, alerts.where(part), path)
    return incremental.features_of(incremental.read_seen(spark, path))


def _excess(spark: SparkSession, sf: str) -> DataFrame:
    model = features.model_features()
    return features.host_hour_excess(_features(spark, sf)).select(
        "agent", "hour", *[F.round(c, 9).alias(c) for c in model], "excess_score"
    )


def _truth(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.malicious_host_hours(derived.alerts(spark, sf), derived.planted(spark, sf))


def _flagged(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.flag_malicious(ranking.excess_table(derived.alerts(spark, sf)), _truth(spark, sf))


def _baselines(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.baseline_ranking(stored(_flagged(spark, sf)))


def _baseline_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return _baselines(spark, sf).select(
        "agent", "hour", "alerts", "excess_score", "is_malicious", "heur_rank", "volume_rank"
    )


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    scored = ranking.anomaly_scores(derived.alerts(spark, sf))
    return ranking.flag_malicious(scored, _truth(spark, sf))


def _ranked(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.host_hour_scores(derived.alerts(spark, sf), derived.planted(spark, sf))


def _combined(spark: SparkSession, sf: str) -> DataFrame:
    return _ranked(spark, sf).select(
        "agent", "hour", "anomaly_score", "excess_score", *ranking_columns()
    )


def ranking_columns() -> list[str]:
    return ["if_rank", "heur_rank", "volume_rank", "combined_rank", "combined_position"]


def queries() -> dict[str, Query]:
    tuned = {"min_alerts": MIN_ALERTS}
    by_heuristic = {"rank": "heur_rank"}
    return {
        "load_alerts": _load_alerts,
        "load_triage": _load_triage,
        "load_planted": lambda spark, sf: raw.load_planted(spark, _truth_path(spark, sf)),
        "load_incidents": lambda spark, sf: raw.load_incidents(
            spark, _truth_path(spark, sf), derived.INCIDENT_HOSTS
        ),
        "load_counts": _load_counts,
        "daily_volume_of_days": _volume_of_days,
        "replaced_days": _replaced_days,
        "triage_of_days": _triage_of_days,
        "latest_triage": lambda spark, sf: latest_triage(derived.triage_again(spark, sf)),
        "repeated_triage": lambda spark, sf: repeated_triage(derived.triage_again(spark, sf)),
        "streamed_hourly_severity": _streamed,
        "daily_volume_by_severity": _on_alerts(volume.daily_volume_by_severity),
        "chart_daily_volume": _on_alerts(volume.chart_daily_volume),
        "noisy_rules": _on_both(tuning.noisy_rules, **tuned),
        "chart_noisy_rules": _on_both(tuning.chart_noisy_rules, **tuned),
        "time_to_triage": _on_both(latency.time_to_triage),
        "triage_by_hour": _on_both(latency.triage_by_hour),
        "mitre_coverage": _on_both(coverage.mitre_coverage),
        "hourly_heatmap": _on_alerts(volume.hourly_heatmap),
        "hourly_heatmap_grid": _on_alerts(volume.hourly_heatmap_grid),
        "burst_detection": _on_alerts(bursts.burst_detection),
        "all_bursts": _on_alerts(bursts.burst_detection, limit=None),
        "top_source_ips": _on_alerts(bursts.top_source_ips),
        "attack_chains": _on_alerts(chains.attack_chains),
        "all_attack_chains": _on_alerts(chains.attack_chains, limit=None),
        "attack_chain_members": _on_alerts(members.attack_chain_members),
        "escalated_alerts": _on_both(escalated_alerts),
        "approx_source_breadth": _source_breadth,
        "approx_time_to_open": _time_to_open,
        "report_results": _report_results,
        "written_workload": _written_report("analyst_workload"),
        "analyst_workload": lambda spark, sf: latency.analyst_workload(derived.triage(spark, sf)),
        "untriaged_high_severity": _on_both(coverage.untriaged_high_severity),
        "untriaged_alerts": _on_both(untriaged_alerts),
        "tuning_candidates": _on_both(volume.tuning_candidates, **tuned),
        "weekly_trend_after_tuning": _on_both(volume.weekly_trend_after_tuning, **tuned),
        "host_hour_features": _features,
        "host_hour_features_by_day": _features_by_day,
        "host_hour_excess": _excess,
        "malicious_host_hours": _truth,
        "baseline_ranking": _baseline_ranking,
        "baseline_precision_recall_at_k": lambda spark, sf: evaluate.precision_recall_at_k(
            _baselines(spark, sf), methods=evaluate.BASELINES
        ),
        "baseline_incident_ranks": lambda spark, sf: evaluate.incident_ranks(
            _baselines(spark, sf), derived.incidents(spark, sf), methods=evaluate.BASELINES
        ),
        "baseline_top_anomalies": lambda spark, sf: evaluate.top_anomalies(
            _baselines(spark, sf), score="excess_score", **by_heuristic
        ),
        "baseline_feature_importance": lambda spark, sf: evaluate.feature_importance(
            _baselines(spark, sf), **by_heuristic
        ),
        "baseline_score_histogram": lambda spark, sf: evaluate.score_histogram(
            _flagged(spark, sf), score="excess_score"
        ),
        "scoring_summary": lambda spark, sf: evaluate.scoring_summary(_flagged(spark, sf)),
        "anomaly_scores": lambda spark, sf: ranking.anomaly_scores(derived.alerts(spark, sf)).select(
            "agent", "hour", "anomaly_score"
        ),
        "stored_forest_scores": _scores_of_stored_forest,
        "combined_ranking": _combined,
        "host_hour_scores": _stored_scores,
        "precision_recall_at_k": lambda spark, sf: evaluate.precision_recall_at_k(_ranked(spark, sf)),
        "incident_ranks": lambda spark, sf: evaluate.incident_ranks(
            _ranked(spark, sf), derived.incidents(spark, sf)
        ),
        "top_anomalies": lambda spark, sf: evaluate.top_anomalies(_ranked(spark, sf)),
        "feature_importance": lambda spark, sf: evaluate.feature_importance(_ranked(spark, sf)),
        "score_histogram": lambda spark, sf: evaluate.score_histogram(_scored(spark, sf)),
    }
