"""Host-hour features, the forest, ranks and their evaluation."""

import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from alertloom import schemas as S
from alertloom.anomaly import evaluate, features, forest, ranking
from alertloom.operators.rank import global_rank
from alertloom.session import stored

START = dt.datetime(2026, 8, 3)


def test_global_rank_is_dense_over_ties_and_partitions(spark):
    r = random.Random(1)
    rows = [(i, 0.0 if r.random() < 0.4 else r.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, s double").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = global_rank(df, [F.col("s").desc(), F.col("id")], "n").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = sorted(rows, key=lambda x: (-x[1], x[0]))
    assert [(x["id"], x["s"]) for x in sorted(got, key=lambda x: x["n"])] == want
    assert sorted(x["n"] for x in got) == list(range(1, 3001))


def feature_rows(spark, counts, hour0=START):
    names = features.count_features()
    rows = [
        ("h", hour0 + dt.timedelta(hours=i), *([c] * len(names)), 5, 5.0, 0) for i, c in enumerate(counts)
    ]
    schema = "agent string, hour timestamp, " + ", ".join(f"{c} bigint" for c in names)
    return spark.createDataFrame(rows, schema + ", max_level int, avg_level double, maintenance_window int")


def test_excess_is_robust_positive_part(spark):
    got = features.host_hour_excess(feature_rows(spark, [1, 2, 3, 4, 10])).orderBy("hour").collect()
    # median 3, median distance 1
    assert [r["alerts_excess"] for r in got] == pytest.approx([0, 0, 0, math.log1p(1), math.log1p(7)])
    assert got[4]["excess_score"] == pytest.approx(15 * math.log1p(7))
    flat = features.host_hour_excess(feature_rows(spark, [2, 2, 2, 2, 6])).orderBy("hour").collect()
    assert flat[4]["alerts_excess"] == pytest.approx(math.log1p(4))  # no spread: divided by 1


def test_maintenance_hours_have_their_own_baseline(spark):
    hours = feature_rows(spark, [1, 1, 1, 50, 50, 50])
    split = hours.withColumn("maintenance_window", (F.col("alerts") > 1).cast("int"))
    assert features.host_hour_excess(split).agg(F.max("excess_score")).first()[0] == 0
    assert features.host_hour_excess(hours).agg(F.max("excess_score")).first()[0] > 0


def points(spark, n=1500, partitions=4):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 3))
    x[7] = (9, -9, 9)
    rows = [(f"h{i % 10}", START + dt.timedelta(hours=i), *map(float, v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "agent string, hour timestamp, a double, b double, c double").repartition(partitions)


def scores(df, **kw):
    out = forest.isolation_forest(df, ranking.KEY, ["a", "b", "c"], trees=60, **kw)
    return {(r["agent"], r["hour"]): r["anomaly_score"] for r in out.collect()}


def test_forest_finds_the_outlier_whatever_the_partitions(spark):
    one, other = scores(points(spark, partitions=3)), scores(points(spark, partitions=11))
    assert one == other
    assert max(one, key=one.get) == ("h7", START + dt.timedelta(hours=7))
    assert all(0 < s <= 1 for s in one.values())
    assert scores(points(spark), seed=43) != one


def test_every_tree_gets_its_full_sample(spark):
    for n in (40, 300, 1500):
        df = points(spark, n)
        sizes = {
            r["count"]
            for r in forest.tree_samples(df, ranking.KEY, n, trees=50).groupBy("tree_id").count().collect()
        }
        assert sizes == {min(256, n)}


def test_one_rule_samples_at_every_size(spark):
    """Every row has the same chance in every tree, whatever the number of rows."""
    for n in (10_000, 1_000_000):
        df = spark.range(n).select(F.concat(F.lit("h"), (F.col("id") % 50).cast("string")).alias("agent"), F.timestamp_seconds(F.col("id")).alias("hour"), "id")
        got = forest.tree_samples(df, ranking.KEY, n, trees=40)
        stats = got.agg(F.count_distinct("id"), F.count("*"), F.avg("id")).first()
        # 40 samples of 256 rows share few rows and lie evenly over the table.
        distinct = n * (1 - (1 - 256 / n) ** 40)
        assert stats[1] == 40 * 256
        assert abs(stats[0] - distinct) < 0.02 * distinct
        assert abs(stats[2] / n - 0.5) < 0.02


def test_unknown_host_keeps_its_row_and_its_flag(spark):
    rows = [(f"a{i}", START, "r", 15, "t", None, None, None, None, "u", None, None) for i in range(2)]
    alerts = spark.createDataFrame(rows, S.ALERTS)
    truth = ranking.malicious_host_hours(alerts, alerts.select("alert_id"))
    got = ranking.flag_malicious(ranking.excess_table(alerts), truth).collect()
    assert [(r["agent"], r["is_malicious"]) for r in got] == [(None, True)]


def test_scores_are_written_and_read_back(spark, tmp_path):
    rows = [("h", START + dt.timedelta(hours=13 * i), float(i)) for i in range(5)]
    scores = spark.createDataFrame(rows, "agent string, hour timestamp, anomaly_score double")
    ranking.write_scores(scores, str(tmp_path / "s"))
    back = ranking.read_scores(spark, str(tmp_path / "s"))
    assert back.columns == scores.columns
    assert sorted(map(tuple, back.collect())) == sorted(rows)


def test_path_normaliser():
    assert list(forest.expected_path(np.array([1, 2]))) == [0, 1]
    harmonic = math.log(255) + np.euler_gamma
    assert forest.expected_path(np.array([256]))[0] == pytest.approx(2 * harmonic - 2 * 255 / 256)


def test_identical_points_grow_no_tree():
    nodes = forest.grow_tree(np.ones((10, 2)), lambda place: forest.draws(0, 0, place), 4)
    assert nodes == [(-1, 0.0, -1, -1, 10, 0)]


def ranked(spark):
    """20 host-hours; the malicious ones are first, third and twelfth for every method."""
    rows = [(f"h{i}", START, i, i in (1, 3, 12)) for i in range(1, 21)]
    df = spark.createDataFrame(rows, "agent string, hour timestamp, n bigint, is_malicious boolean")
    return df.select("agent", "hour", "is_malicious", *[F.col("n").alias(c) for c in evaluate.METHODS.values()])


def test_precision_and_recall(spark):
    got = evaluate.precision_recall_at_k(ranked(spark), ks=(2, 10, 15)).filter("method = 'combined'")
    assert [(r["k"], r["hits"], r["precision"], r["recall"]) for r in got.orderBy("k").collect()] == [
        (2, 1, 0.5, pytest.approx(1 / 3)),
        (10, 2, 0.2, pytest.approx(2 / 3)),
        (15, 3, 0.2, 1.0),
    ]


def test_incident_without_host_hour_has_no_rank(spark):
    incidents = spark.createDataFrame([("x", "h12", START), ("y", "gone", START)], "incident string, agent string, hour timestamp")
    got = {r["incident"]: r["combined"] for r in evaluate.incident_ranks(ranked(spark), incidents).collect()}
    assert got == {"x": 12, "y": None}


def test_histogram_covers_each_class(spark):
    rows = [(False, x / 10) for x in range(11)] + [(True, 0.5)]
    df = spark.createDataFrame(rows, "is_malicious boolean, s double")
    got = evaluate.score_histogram(df, "s", benign_bins=5, malicious_bins=4).collect()
    benign = [r["host_hours"] for r in got if not r["is_malicious"]]
    malicious = [(r["bin"], r["bin_start"], r["host_hours"]) for r in got if r["is_malicious"]]
    assert sum(benign) == 11 and len(benign) == 5 and benign[-1] == 3  # 0.8, 0.9 and the edge 1.0
    assert malicious == [(0, 0.0, 0), (1, 0.25, 0), (2, 0.5, 1), (3, 0.75, 0)]


def incident_alerts():
    """Six hosts over ten days with noise, one loud hour and one quiet hour of many tactics."""
    r = random.Random(11)
    rows = []

    def add(host, ts, rule, level, tactic, user, ip=None):
        rows.append((f"a{len(rows)}", ts, rule, level, rule, None, tactic, host, ip, user, None, None))

    for host in (f"h{i}" for i in range(6)):
        for hour in range(240):
            for _ in range(r.randrange(1, 30) if host != "h5" else r.randrange(1, 3)):
                ts = START + dt.timedelta(hours=hour, seconds=r.randrange(3600))
                add(host, ts, f"r{r.randrange(3)}", r.choice([3, 5, 7]), "Credential Access", f"u{r.randrange(8)}", "10.0.0.1")
    loud = START + dt.timedelta(hours=100)
    for i in range(420):
        add("h0", loud + dt.timedelta(seconds=4 * i), "r0", 5, "Credential Access", "admin", "185.220.101.44")
    quiet = START + dt.timedelta(hours=150)
    planted = len(rows)
    for i, tactic in enumerate(("Execution", "Persistence", "Privilege Escalation", "Command and Control")):
        add("h5", quiet + dt.timedelta(minutes=i), f"rare{i}", 12, tactic, "u1")
    return rows, loud, quiet, [f"a{i}" for i in range(planted, len(rows))]


def test_scenario_is_found(spark):
    rows, loud, quiet, ids = incident_alerts()
    alerts = spark.createDataFrame(rows, S.ALERTS)
    planted = spark.createDataFrame([(i,) for i in ids], "alert_id string")
    out = ranking.host_hour_scores(alerts, planted, trees=100)
    by_hour = {(r["agent"], r["hour"]): r for r in out.collect()}
    assert [k for k, r in by_hour.items() if r["is_malicious"]] == [("h5", quiet)]
    loud_row, quiet_row = by_hour[("h0", loud)], by_hour[("h5", quiet)]
    assert loud_row["volume_rank"] == 1
    assert loud_row["heur_rank"] <= 5
    # Few alerts, many tactics: invisible by volume, near the top for the forest.
    assert quiet_row["volume_rank"] > 1000
    assert quiet_row["if_rank"] <= 15
    n = len(by_hour)
    for column in ("if_rank", "heur_rank", "volume_rank", "combined_position"):
        assert sorted(r[column] for r in by_hour.values()) == list(range(1, n + 1))
    assert all(r["combined_rank"] == min(r["if_rank"], r["heur_rank"]) for r in by_hour.values())


def test_a_stored_forest_scores_later_rows_alike(spark, tmp_path):
    rows = stored(spark.range(600).select("id", F.rand(1).alias("x"), F.rand(2).alias("y")))
    path = str(tmp_path / "forest")
    forest.write_model(forest.fit(rows, ["id"], ["x", "y"], trees=20), path, ["x", "y"])
    fresh = forest.isolation_forest(rows, ["id"], ["x", "y"], trees=20).where("id % 7 = 0")
    # Other columns and another order of columns change nothing.
    later = rows.where("id % 7 = 0").select("y", F.lit("z").alias("tree_id"), "x", "id")
    scored = forest.score_with_model(later, path).select("id", "anomaly_score")
    assert sorted(scored.collect()) == sorted(fresh.select("id", "anomaly_score").collect())
    with pytest.raises(ValueError, match="needs"):
        forest.score_with_model(rows.drop("y"), path)
    other = str(tmp_path / "other")
    spark.read.parquet(path).withColumn("version", F.lit(99)).write.parquet(other)
    with pytest.raises(ValueError, match="version"):
        forest.read_model(spark, other)
    assert forest.fit(rows.limit(0), ["id"], ["x"]) is None
