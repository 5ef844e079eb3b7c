"""Small random alerts and triage with the awkward cases: NULLs, copies, hot keys, repeats."""

import datetime as dt
import random

from alertloom import schemas as S

START = dt.datetime(2026, 8, 3)


def tables(seed: int, n: int = 400):
    r = random.Random(seed)
    alerts = []
    for i in range(n):
        hot = r.random() < 1 / 3
        ts = START + dt.timedelta(microseconds=r.randrange(3 * 86400 * 10**6))
        if r.random() < 0.3:
            ts = ts.replace(minute=0, second=0, microsecond=0)
        rule = r.choice(["r1", "r2", "r3", "r4", None])
        alerts.append(
            (
                f"a{i}" if r.random() > 0.02 else None,
                ts,
                rule,
                r.choice([None, 3, 6, 7, 8, 9, 10, 11, 12, 15]),
                f"text {rule} {r.randrange(2)}" if r.random() > 0.05 else None,
                None,
                r.choice([None, "Made Up", *S.FEATURE_TACTICS[:6]]),
                "hot" if hot else r.choice(["h1", "h2", "h3", "h4", None]),
                r.choice([None, "10.0.0.1", "10.0.0.2", "192.168.0.1", "8.8.8.8", "9.9.9.9"]),
                r.choice([None, "u1", "u2", "u3", "u4", "svc", "svc"]),
                None,
                None,
            )
        )
    for _ in range(n // 10):
        alerts.append(r.choice(alerts))
    triage = []
    for _ in range(n):
        aid, ts = r.choice(alerts)[:2] if r.random() > 0.05 else ("orphan", START)
        opened = ts + dt.timedelta(seconds=r.uniform(-60, 20000))
        triage.append(
            (
                aid,
                opened if r.random() > 0.03 else None,
                opened + dt.timedelta(seconds=r.uniform(0, 5000)) if r.random() > 0.03 else None,
                r.choice(["x", "y", None]),
                r.choice(["true_positive", "false_positive", "benign", None]),
                r.choice([True, False, None]),
            )
        )
    for _ in range(n // 10):
        triage.append(r.choice(triage))
    return alerts, triage


def frames(spark, seed: int, n: int = 400):
    alerts, triage = tables(seed, n)
    return (
        spark.createDataFrame(alerts, S.ALERTS).repartition(4),
        spark.createDataFrame(triage, S.TRIAGE).repartition(4),
    )


def load_duckdb(con, seed: int, n: int = 400):
    alerts, triage = tables(seed, n)
    con.execute(
        "create or replace table alerts (alert_id varchar, ts timestamp, rule_id varchar, level int, "
        "rule_description varchar, mitre_technique varchar, mitre_tactic varchar, agent varchar, "
        "src_ip varchar, src_user varchar, dst_user varchar, location varchar)"
    )
    con.execute(
        "create or replace table triage (alert_id varchar, opened_at timestamp, closed_at timestamp, "
        "analyst varchar, disposition varchar, escalated boolean)"
    )
    con.executemany(f"insert into alerts values ({','.join('?' * 12)})", alerts)
    con.executemany(f"insert into triage values ({','.join('?' * 6)})", triage)
