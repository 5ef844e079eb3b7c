"""Multi-stage activity: what follows an alert on the same host or by the same user.

The question joins each severe alert (the anchor) to every severe alert within the window that
shares its host or its user. Writing that join out makes pairs, and their number grows with the
square of a busy host. None of the answers needs the pairs. Time is cut into slots as long as the
window, so the window of an anchor in slot s ends in slot s + 1.

* Which tactics follow? A tactic occurs in the window exactly if its last time in slot s is not
  before the anchor, or its first time in slot s + 1 is not after the window's end. Two times per
  (host or user, slot, tactic) decide it. This alone selects the candidates.
* When does the window end? At the latest alert not after its nominal end: the last one of slot s,
  or a running maximum in slot s + 1.
* How many hosts? Those where the anchor's user was seen. In slot s + 1 a host counts from the
  start until one window after its last alert of slot s, and again from its first alert of slot
  s + 1. A running sum of +1 and -1 at these times is the number of hosts at any time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from alertloom.functions import exprs as E
from alertloom.operators.timeline import MICROS, running, slot_of
from alertloom.session import stored

HOST, USER = 0, 1


def _severe(alerts: DataFrame, min_level: int, tactics: Sequence[str] | None = None) -> DataFrame:
    """The few columns of the severe alerts, written once: a small part of the alerts, read often.

    Rebalanced, so that every task of the large scan does not leave a small file.
    """
    severe = alerts.filter(
        (F.col("level") >= min_level)
        & (F.col("mitre_tactic").isNotNull() if tactics is None else F.col("mitre_tactic").isin(*tactics))
        & F.col("ts").isNotNull()
        & (F.col("agent").isNotNull() | F.col("src_user").isNotNull())
    ).select(
        "alert_id",
        "agent",
        "src_user",
        F.unix_micros(E.instant(F.col("ts"))).alias("t"),
        F.col("mitre_tactic").alias("tactic"),
    )
    return stored(severe.hint("rebalance"))


def _by_key(rows: DataFrame) -> DataFrame:
    """Each row once under its host and once under its user."""
    keyed = F.array(
        F.struct(F.lit(HOST).alias("kind"), F.col("agent").alias("key")),
        F.struct(F.lit(USER).alias("kind"), F.col("src_user").alias("key")),
    )
    return rows.select("*", F.inline(keyed)).filter(F.col("key").isNotNull())


def _tactic_times(severe: DataFrame, window: int) -> DataFrame:
    """Per (key, slot): for each tactic its last time in the slot or first time in the next."""
    times = (
        _by_key(severe)
        .groupBy("kind", "key", slot_of(F.col("t"), window).alias("slot"), "tactic")
        .agg(F.min("t").alias("first"), F.max("t").alias("last"))
    )
    none = F.lit(None).cast("bigint")
    both = F.array(
        F.struct(F.col("slot"), F.col("last"), none.alias("first")),
        F.struct((F.col("slot") - 1).alias("slot"), none.alias("last"), F.col("first")),
    )
    # A list holds at most two entries per tactic. Tactics come from the detection rules, a vocabulary
    # of tens of names; pass `tactics` to `attack_chains` where the field is free text.
    return (
        times.select("kind", "key", "tactic", F.inline(both))
        .groupBy("kind", "key", "slot")
        .agg(F.collect_list(F.struct("tactic", "last", "first")).alias("times"))
    )


# Tasks that anchors without a host, or without a user, are spread over.
_SPREAD = 64


def _seen_by(anchors: DataFrame, times: DataFrame, kind: int, key: str, window: int) -> DataFrame:
    """Add what the anchor's host or user saw: `<key>_tactics` in the window, `<key>_before` in the slot.

    The list of times is reduced to the window's tactics right after the join, so only these travel
    on. Anchors without a key see nothing; they are spread over the tasks instead of meeting in one.
    """
    seen = times.filter(F.col("kind") == kind).select(F.col("key").alias("_key"), F.col("slot").alias("_slot"), "times")
    nobody = F.pmod(F.xxhash64(*[F.col(c) for c in anchors.columns if c != key]), F.lit(_SPREAD))
    # The slot of a key that is unknown is one that no alert can have.
    slot = F.when(F.col(key).isNull(), F.lit(-(2**62)) + nobody).otherwise(F.col("slot"))
    inside = F.filter("times", lambda x: (x["last"] >= F.col("t")) | (x["first"] <= F.col("t") + window))
    tactics = F.array_distinct(F.transform(inside, lambda x: x["tactic"]))
    placed = anchors.withColumns({"_at": slot, "_of": F.coalesce(F.col(key), F.lit(""))})
    joined = placed.join(seen, (F.col("_of") == F.col("_key")) & (F.col("_at") == F.col("_slot")), "left")
    return joined.select(
        *anchors.columns,
        F.coalesce(tactics, _none()).alias(f"{key}_tactics"),
        F.array_max(F.transform("times", lambda x: x["last"])).alias(f"{key}_before"),
    )


def _none() -> Column:
    return F.array().cast("array<string>")


def _candidates(severe: DataFrame, min_tactics: int, window: int) -> DataFrame:
    """Distinct (agent, src_user, t) whose window holds enough tactics.

    `before` is the latest alert of the anchor's own slot.
    """
    times = _tactic_times(severe, window)
    anchors = severe.select("agent", "src_user", "t").distinct().withColumn("slot", slot_of(F.col("t"), window))
    by_host = _seen_by(anchors, times, HOST, "agent", window)
    by_both = _seen_by(by_host, times, USER, "src_user", window)
    return (
        by_both.select(
            "agent",
            "src_user",
            "t",
            "slot",
            F.array_sort(F.array_union("agent_tactics", "src_user_tactics")).alias("tactics"),
            F.greatest("agent_before", "src_user_before").alias("before"),
        )
        .filter(F.size("tactics") >= min_tactics)
    )


def _host_changes(severe: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """+1 where a host of the user starts to count in a slot, -1 just after it stops."""
    runs = (
        severe.filter(F.col("src_user").isNotNull() & F.col("agent").isNotNull())
        .groupBy(F.col("src_user").alias("key"), "agent", slot_of(F.col("t"), window).alias("slot"))
        .agg(F.min("t").alias("first"), F.max("t").alias("last"))
    )
    none = F.lit(None).cast("bigint")
    both = F.array(
        F.struct(F.col("slot"), F.col("first"), none.alias("until")),
        F.struct(
            (F.col("slot") + 1).alias("slot"), none.alias("first"), (F.col("last") + window).alias("until")
        ),
    )
    merged = (
        runs.select("key", "agent", F.inline(both))
        .join(wanted.filter(F.col("kind") == USER).drop("kind"), ["key", "slot"], "left_semi")
        .groupBy("key", "agent", "slot")
        .agg(F.min("first").alias("first"), F.max("until").alias("until"))
    )
    first, until = F.col("first"), F.col("until")
    gap = first > until + 1
    starts = F.when(until.isNotNull(), F.struct((F.col("slot") * window).alias("at"), F.lit(1).alias("hosts")))
    stops = F.when(
        until.isNotNull() & (first.isNull() | gap),
        F.struct((until + 1).alias("at"), F.lit(-1).alias("hosts")),
    )
    again = F.when(
        first.isNotNull() & (until.isNull() | gap), F.struct(first.alias("at"), F.lit(1).alias("hosts"))
    )
    return merged.select(
        F.lit(USER).alias("kind"),
        "key",
        "slot",
        F.inline(F.array_compact(F.array(starts, stops, again))),
    )


def _windows(severe: DataFrame, min_tactics: int, window: int) -> DataFrame:
    """Windows with at least `min_tactics` tactics, one row per distinct (host, user, start).

    The candidates are written once, with a number each. Only the number goes through the time line;
    what else is known of a candidate joins its answers at the end.
    """
    found = _candidates(severe, min_tactics, window)
    candidates = stored(found.withColumn("candidate", F.monotonically_increasing_id()))

    # A question stands at the window's nominal end.
    asked = _by_key(candidates).select(
        "kind",
        "key",
        (F.col("slot") + 1).alias("slot"),
        (F.col("t") + window).alias("at"),
        "candidate",
    )
    wanted = asked.select("kind", "key", "slot").distinct()
    events = (
        _by_key(severe)
        .select("kind", "key", slot_of(F.col("t"), window).alias("slot"), F.col("t").alias("at"))
        .join(wanted, ["kind", "key", "slot"], "left_semi")
        .withColumn("latest", F.col("at"))
    )
    line = (
        events.unionByName(_host_changes(severe, wanted, window), allowMissingColumns=True)
        .groupBy("kind", "key", "slot", "at")
        .agg(F.sum("hosts").alias("hosts"), F.max("latest").alias("latest"))
        .unionByName(asked, allowMissingColumns=True)
    )
    answers = running(line, ["kind", "key", "slot"], "at", {"hosts": F.sum, "latest": F.max})
    # Host and user answers of one candidate meet again. Without a user only the host itself counts.
    ends = (
        answers.filter(F.col("candidate").isNotNull())
        .groupBy("candidate")
        .agg(
            F.max("latest").alias("latest"),
            F.max(F.when(F.col("kind") == USER, F.col("hosts"))).alias("hosts"),
        )
    )
    return candidates.join(ends, "candidate").select(
        F.col("agent").alias("first_host"),
        "src_user",
        F.timestamp_micros("t").alias("window_start"),
        F.timestamp_micros(F.greatest("before", "latest")).alias("window_end"),
        F.size("tactics").cast("bigint").alias("tactics_in_window"),
        F.when(F.col("src_user").isNull(), F.lit(1).cast("bigint"))
        .otherwise(F.coalesce("hosts", F.lit(0).cast("bigint")))
        .alias("hosts_in_window"),
        F.array_join("tactics", " | ").alias("tactics_seen"),
    )


def _order() -> list[Column]:
    return [
        F.col("tactics_in_window").desc(),
        F.col("hosts_in_window").desc(),
        F.col("window_start").asc(),
        F.col("first_host").asc_nulls_last(),
        F.col("src_user").asc_nulls_last(),
    ]


def attack_chains(
    alerts: DataFrame,
    min_tactics: int = 3,
    min_level: int = 8,
    window_seconds: int = 7200,
    limit: int | None = 10,
    tactics: Sequence[str] | None = None,
) -> DataFrame:
    """Chains of at least `min_tactics` tactics, broadest first, one row per opening alert.

    With `tactics`, alerts of other tactics are left out. Runs jobs when called.
    """
    severe = _severe(alerts, min_level, tactics)
    windows = _windows(severe, min_tactics, window_seconds * MICROS)
    if limit is not None:
        # Further windows cannot reach a report of `limit` rows, each having at least one alert.
        windows = windows.orderBy(*_order()).limit(limit)
    opening = severe.select("alert_id", "agent", F.col("src_user").alias("user"), "t")
    # Alerts that open the same window are rows of their own.
    chains = (
        opening.join(
            windows,
            F.col("agent").eqNullSafe(F.col("first_host"))
            & F.col("user").eqNullSafe(F.col("src_user"))
            & (F.timestamp_micros("t") == F.col("window_start")),
        )
        .select("alert_id", *windows.columns)
        .distinct()
        .drop("alert_id")
    )
    return chains if limit is None else chains.orderBy(*_order()).limit(limit)
