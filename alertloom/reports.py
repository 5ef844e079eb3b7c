"""The reports by name: run all or some of them, write their results, or look at the first rows."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row

from alertloom.operators.bloom import may_match
from alertloom.operators.chains import attack_chains
from alertloom.operators.joins import triaged_alerts
from alertloom.plans import bursts, coverage, latency, tuning, volume
from alertloom.session import stored

PREVIEW_ROWS = 60


@dataclass(frozen=True)
class Report:
    number: str
    name: str
    question: str
    build: Callable[[DataFrame, DataFrame, DataFrame | None], DataFrame]
    # Whether it asks which alerts were triaged; several such reports share the answer.
    joins: bool = False


REPORTS = (
    Report("01", "daily_volume_by_severity", "Is the daily load stable or spiky, by severity?",
           lambda a, t, j: volume.daily_volume_by_severity(a)),
    Report("02", "noisy_rules", "Which rules fire most, and how often are they real?",
           lambda a, t, j: tuning.noisy_rules(a, t, triaged=j), joins=True),
    Report("03", "time_to_triage", "How long until an alert is opened and closed, and is the SLA met?",
           lambda a, t, j: latency.time_to_triage(j or a, t), joins=True),
    Report("04", "triage_by_hour", "Does time to triage degrade overnight?",
           lambda a, t, j: latency.triage_by_hour(j or a, t), joins=True),
    Report("05", "mitre_coverage", "Which tactics have detections, confirmations or neither?",
           lambda a, t, j: coverage.mitre_coverage(a, t, triaged=j), joins=True),
    Report("06", "hourly_heatmap", "When do alerts fire, by weekday and hour?",
           lambda a, t, j: volume.hourly_heatmap(a)),
    Report("07", "burst_detection", "In which hours did a rule on a host exceed its own normal?",
           lambda a, t, j: bursts.burst_detection(a)),
    Report("08", "top_source_ips", "Which external sources touch the most rules and hosts?",
           lambda a, t, j: bursts.top_source_ips(a)),
    Report("09", "attack_chains", "Which alerts start a sequence of several tactics?",
           lambda a, t, j: attack_chains(a)),
    Report("10", "analyst_workload", "How much does each analyst close, and with which outcomes?",
           lambda a, t, j: latency.analyst_workload(t)),
    Report("11", "untriaged_high_severity", "Which severe alerts did nobody open?",
           lambda a, t, j: coverage.untriaged_high_severity(a, t, triaged=j), joins=True),
    Report("12", "weekly_trend_after_tuning", "What would the volume be with the noisy rules suppressed?",
           lambda a, t, j: volume.weekly_trend_after_tuning(a, t, triaged=j), joins=True),
)


def select(names: Iterable[str] = ()) -> list[Report]:
    """Reports by two-digit number or name; all of them if none is named."""
    wanted = list(names)
    unknown = set(wanted) - {r.number for r in REPORTS} - {r.name for r in REPORTS}
    if unknown:
        raise KeyError(f"unknown reports: {sorted(unknown)}")
    return [r for r in REPORTS if not wanted or r.number in wanted or r.name in wanted]


def run(
    alerts: DataFrame, triage: DataFrame, names: Iterable[str] = (), bloom: bool = False
) -> dict[str, DataFrame]:
    """A result per report name.

    Most results are plans that have not run. If several of the chosen reports ask which alerts were
    triaged, all alerts are joined with triage here, once, and the triaged ones are written to the
    scratch folder. The latency reports (03, 04) and attack chains (09) also run jobs here: each writes a
    part that it uses more than once.

    Where few alerts are triaged, `bloom` drops most of the others before they are moved for the join.
    """
    chosen = select(names)
    shared = None
    if sum(r.joins for r in chosen) > 1:
        known = may_match(alerts, triage.select("alert_id"), "alert_id") if bloom else alerts
        shared = stored(triaged_alerts(known, triage))
    return {r.name: r.build(alerts, triage, shared) for r in chosen}


def write_results(results: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """One folder per report, replaced if present."""
    for name, df in results.items():
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.format(fmt).save(f"{folder}/{name}")


def preview(df: DataFrame, rows: int = PREVIEW_ROWS) -> tuple[list[Row], int]:
    """The first `rows` rows and the number of all rows."""
    first = df.limit(rows + 1).collect()
    return first[:rows], (len(first) if len(first) <= rows else df.count())
