"""Schemas and domain constants shared by every operator."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values (domain constants; results depend on them exactly) -------------------

# Lowest level of each band; anything below 7 is "low".
SEVERITY_FLOORS = (("critical", 12), ("high", 10), ("medium", 7))
DEFAULT_SEVERITY = "low"


def floor_of(severity: str) -> int:
    """The lowest level of a band above the default one."""
    return dict(SEVERITY_FLOORS)[severity]


SEVERITY_ORDER = ("critical", "high", "medium", "low")

# Minutes an analyst has to open an alert.
SLA_MINUTES = {"critical": 15, "high": 30, "medium": 60, "low": 240}

# ATT&CK tactics used for the coverage report.
TACTICS = (
    "Initial Access",
    "Execution",
    "Persistence",
    "Privilege Escalation",
    "Defense Evasion",
    "Credential Access",
    "Discovery",
    "Lateral Movement",
    "Collection",
    "Command and Control",
    "Exfiltration",
    "Impact",
)

# Tactics that get their own count column in the host-hour features.
FEATURE_TACTICS = (
    "Credential Access",
    "Initial Access",
    "Persistence",
    "Privilege Escalation",
    "Execution",
    "Discovery",
    "Command and Control",
    "Impact",
)

TRUE_POSITIVE = "true_positive"
FALSE_POSITIVE = "false_positive"

TUNE = "TUNE: high volume, ~never true"
KEEP = "KEEP: high fidelity"
REVIEW = "review"

BLIND_SPOT = "BLIND SPOT: no detection rule"
UNCONFIRMED = "no confirmed detections in 30 days"
COVERED = "covered"

INTERNAL_PREFIX = "10."

# (ISO weekday, first hour, last hour), UTC: the Tuesday patch window.
MAINTENANCE_WINDOWS = ((2, 2, 3),)

# Incident name -> host it was seen on first.
INCIDENT_HOSTS = {
    "ssh_brute_force_vpn01": "vpn-01",
    "lateral_movement_ws017_dc01": "ws-017",
    "web_scan_sqli_web01": "web-01",
}

# --- Raw inputs ------------------------------------------------------------------------

_STR = T.StringType()


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, _STR) for n in names])


# Only the fields that reach the alerts table are declared: for JSON the reader schema is the
# column pruning. `level` is read as text so that a quoted number is accepted, and cast later.
RAW_ALERT = T.StructType(
    [
        T.StructField("id", _STR),
        T.StructField("timestamp", _STR),
        T.StructField(
            "rule",
            T.StructType(
                [
                    T.StructField("id", _STR),
                    T.StructField("level", _STR),
                    T.StructField("description", _STR),
                    T.StructField(
                        "mitre",
                        T.StructType(
                            [
                                T.StructField("id", T.ArrayType(_STR)),
                                T.StructField("tactic", T.ArrayType(_STR)),
                            ]
                        ),
                    ),
                ]
            ),
        ),
        T.StructField("agent", _strings("name")),
        T.StructField("data", _strings("srcip", "srcuser", "dstuser")),
        T.StructField("location", _STR),
    ]
)

RAW_TRIAGE = _strings("alert_id", "opened_at", "closed_at", "analyst", "disposition", "escalated")

CORRUPT = "_corrupt_record"

# --- Loaded tables ---------------------------------------------------------------------

ALERTS = T.StructType(
    [
        T.StructField("alert_id", _STR),
        T.StructField("ts", T.TimestampType()),
        T.StructField("rule_id", _STR),
        T.StructField("level", T.IntegerType()),
        T.StructField("rule_description", _STR),
        T.StructField("mitre_technique", _STR),
        T.StructField("mitre_tactic", _STR),
        T.StructField("agent", _STR),
        T.StructField("src_ip", _STR),
        T.StructField("src_user", _STR),
        T.StructField("dst_user", _STR),
        T.StructField("location", _STR),
    ]
)

TRIAGE = T.StructType(
    [
        T.StructField("alert_id", _STR),
        T.StructField("opened_at", T.TimestampNTZType()),
        T.StructField("closed_at", T.TimestampNTZType()),
        T.StructField("analyst", _STR),
        T.StructField("disposition", _STR),
        T.StructField("escalated", T.BooleanType()),
    ]
)
