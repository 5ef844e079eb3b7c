"""Points in ranges, and the members of chains, against pairs."""

import datetime as dt
import random
from collections import Counter

import pytest
from randomdata import frames, tables

from alertloom.operators import intervals
from alertloom.operators.chains import attack_chains
from alertloom.plans import members


def brute(points, ranges):
    return Counter((*p, *r[1:]) for p in points for r in ranges if None not in (p[0], p[1], r[0]) and p[0] == r[0] and r[1] <= p[1] <= r[2])


def joined(spark, points, ranges, width, together):
    p = spark.createDataFrame(points, "key string, at long, name string").repartition(3)
    r = spark.createDataFrame(ranges, "key string, low long, high long")
    got = intervals.points_in_ranges(p, r, ["key"], "at", "low", "high", width, together)
    return Counter(tuple(x) for x in got.select("key", "at", "name", "low", "high").collect())


@pytest.mark.parametrize("width,together", [(10, 1000), (10, 3), (1, 2), (1000, 1)])
def test_pairs_equal_brute_force(spark, width, together):
    r = random.Random(width + together)
    points = [(r.choice(["hot", "hot", "k1", "k2", None]), r.choice([None, *range(-40, 60)]), f"p{i % 50}") for i in range(300)]
    points += [("hot", 7, "same")] * 20
    ranges = []
    for _ in range(40):
        low = r.randrange(-50, 60)
        ranges.append((r.choice(["hot", "k1", "k3", None]), low, low + r.choice([0, 5, 10, 25, -1])))
    ranges += ranges[:5]
    assert joined(spark, points, ranges, width, together) == brute(points, ranges)


def test_a_crowded_slot_is_dealt_over_several_tasks(spark):
    p = spark.range(0, 5000, 1, 4).selectExpr("'hot' as key", "id % 5 as at", "id as name")
    r = spark.createDataFrame([("hot", 0, 2), ("cold", 0, 9)], "key string, low long, high long")
    got = intervals.points_in_ranges(p, r, ["key"], "at", "low", "high", 100, 200)
    assert got.count() == 3000
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text and "_salt" in text


def test_no_rows(spark):
    assert not joined(spark, [], [("a", 0, 1)], 10, 10)
    assert not joined(spark, [("a", 0, "x")], [], 10, 10)


def member_pairs(rows, chains):
    severe = [r for r in rows if r[3] is not None and r[3] >= 8 and r[6] is not None]
    out = []
    for host, user, start in sorted({(c["first_host"], c["src_user"], c["window_start"]) for c in chains}, key=repr):
        for a in severe:
            by_host = a[7] is not None and a[7] == host
            by_user = a[9] is not None and a[9] == user
            if (by_host or by_user) and start <= a[1] <= start + dt.timedelta(hours=2):
                shares = "both" if by_host and by_user else "host" if by_host else "user"
                out.append((host, user, start, a[0], a[1], a[2], a[3], a[6], a[7], a[9], shares))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,limit,together", [(5, 10, 50_000), (6, None, 2)])
def test_members_of_chains(spark, seed, limit, together):
    rows, _ = tables(seed)
    alerts, _ = frames(spark, seed)
    chains = attack_chains(alerts, limit=limit)
    given = chains.collect()
    got = sorted(map(tuple, members.chain_members(alerts, chains, together=together).collect()), key=repr)
    assert given and got == member_pairs(rows, given)
    # The hot host of the random tables opens chains; its alerts are listed like any other's.
    assert any(r[0] == "hot" for r in got)


def test_members_tell_what_the_chain_counts(spark):
    alerts, _ = frames(spark, 8)
    chains = attack_chains(alerts).collect()
    found = {}
    for r in members.attack_chain_members(alerts).collect():
        found.setdefault((r["first_host"], r["src_user"], r["window_start"]), []).append(r)
    for c in chains:
        mine = found[(c["first_host"], c["src_user"], c["window_start"])]
        assert " | ".join(sorted({r["mitre_tactic"] for r in mine})) == c["tactics_seen"]
        assert max(r["ts"] for r in mine) == c["window_end"]
        assert len({r["agent"] for r in mine} - {None}) == c["hosts_in_window"]
