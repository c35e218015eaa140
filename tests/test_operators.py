"""Dedupe, merge, joins, quantiles, hashes, metrics, top-k."""

import json
import random
from datetime import date, datetime, timezone

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from contrail.operators import dedupe, enrich, hashing, merge, project, quality, quantiles, rollup, skew, topk
from contrail.operators.enrich import Dimension
from contrail.operators.quantiles import exact_quantiles
from contrail.plans import gold, measures, silver
from contrail.session import pin_utc, stage

RUN = datetime(2024, 2, 1, tzinfo=timezone.utc)
SMALL = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_dedupe(spark, rows):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", None, "w")], "k string, t int, v string")
    assert rows(dedupe.latest_per_key(df, ["k"], ["t"])) == [("a", 3, "y"), ("b", None, "w")]
    assert rows(dedupe.earliest_per_key(df, ["k"], ["t"])) == [("a", 1, "x"), ("b", None, "w")]
    once = dedupe.latest_per_key(df, ["k"], ["t"])
    assert rows(dedupe.latest_per_key(once, ["k"], ["t"])) == rows(once)


def test_allowlist_and_union(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert project.select_allowlist(df, ["c", "zz", "a"]).columns == ["c", "a"]
    other = spark.createDataFrame([(9,)], "b int")
    assert [tuple(r) for r in project.union_by_name(df, other).collect()] == [(1, 2, 3), (None, 9, None)]


@SMALL
@given(
    target=st.dictionaries(st.integers(0, 9), st.integers(0, 3), max_size=8),
    source=st.dictionaries(st.integers(0, 9), st.integers(0, 3), max_size=8),
)
def test_upsert_is_a_dict_update(spark, target, source):
    t = spark.createDataFrame(list(target.items()), "k int, v int")
    s = spark.createDataFrame(list(source.items()), "k int, v int")
    once = merge.upsert(t, s, ["k"])
    assert {r["k"]: r["v"] for r in once.collect()} == {**target, **source}
    assert {r["k"]: r["v"] for r in merge.upsert(once, s, ["k"]).collect()} == {**target, **source}


def test_upsert_keeps_columns_the_source_lacks(spark, rows):
    t = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, w int")
    s = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert rows(merge.upsert(t, s, ["k"])) == [(1, "a", 10), (2, "B", 20), (3, "C", None)]


def test_conditional_merge_is_null_safe(spark, rows):
    ddl = "k int, status string, h string, run string"
    t = spark.createDataFrame(
        [(1, "done", None, "old"), (2, "done", None, "old"), (3, "done", "x", "old"), (4, "failed", "x", "old"), (5, "done", "x", "old")], ddl
    )
    s = spark.createDataFrame(
        [(1, "done", None, "new"), (2, "done", "x", "new"), (3, "done", None, "new"), (4, "done", "x", "new"), (6, "done", "x", "new")], ddl
    )
    updates = {c: F.col(f"s.{c}") for c in ("status", "h", "run")}
    got = merge.merge(t, s, ["k"], updates, merge.differs(["status", "h"]))
    assert rows(got, "k", "run") == [(1, "old"), (2, "new"), (3, "new"), (4, "new"), (5, "old"), (6, "new")]


def test_duplicate_source_keys_are_refused(spark):
    df = spark.createDataFrame([(1, 1), (1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="duplicate source key"):
        merge.require_unique(df, ["k"])


@SMALL
@given(batches=st.lists(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 5)), max_size=5), min_size=2, max_size=3))
def test_newest_wins_in_any_order(spark, batches):
    frames = [spark.createDataFrame(b, "k int, t int, v int") for b in batches]

    def apply(order):
        state = spark.createDataFrame([], "k int, t int, v int")
        for i in order:
            state = merge.upsert_newest(state, frames[i], ["k"], ["t"])
        return sorted(map(tuple, state.collect()))

    forward = list(range(len(frames)))
    assert apply(forward) == apply(forward[::-1]) == apply(forward + forward[:1])


def test_dimension_join_forms_agree(spark, rows, plan):
    fact = spark.createDataFrame([(i, "a" if i % 3 == 0 else None if i % 3 == 1 else f"k{i}") for i in range(60)], "id int, code string").repartition(6)
    dim = spark.createDataFrame([("a", "A"), ("k2", "K2"), (None, "none")], "key string, name string")
    for how in ("left", "inner"):
        small = enrich.join_dimension(fact, Dimension(dim, True), {"code": "key"}, {"name": "label"}, how)
        large = enrich.join_dimension(fact, Dimension(dim, False), {"code": "key"}, {"name": "label"}, how)
        assert rows(small) == rows(large)
        assert small.columns == ["id", "code", "label"]
    assert "BroadcastHashJoin" in plan(small)
    matched = dict(rows(enrich.join_dimension(fact, dim, {"code": "key"}, {"name": "label"}), "id", "label"))
    assert matched[0] == "A" and matched[1] is None and matched[5] is None and len(matched) == 60


def test_broadcast_is_measured(spark):
    dim = spark.range(50).withColumn("text", F.lit("x" * 100))
    assert enrich.fits_broadcast(dim)
    assert not enrich.fits_broadcast(dim, max_rows=49)
    assert not enrich.fits_broadcast(dim, max_bytes=1000)
    assert enrich.fits_broadcast(dim.limit(0))


def test_salted_join_spreads_a_hot_key(spark):
    fact = spark.range(0, 8000, 1, 8).select(F.lit("hot").alias("code"), "id")
    dim = spark.createDataFrame([("hot", "H")], "key string, name string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        joined = enrich.join_dimension(fact, Dimension(dim, False), {"code": "key"}, {"name": "label"})
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(r["count"] for r in sizes) == 8000
    assert len(sizes) >= 4 and max(r["count"] for r in sizes) <= 4000


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [3.0] * 7 + [9.5, -4.25, 100.0], [float(x * x % 37) for x in range(101)]])
def test_quantiles_match_linear_interpolation(spark, values):
    qs = [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "x double")
    got = {r["q"]: r["value"] for r in exact_quantiles(df, "x", qs).collect()}
    assert got == pytest.approx({q: float(np.quantile(values, q)) for q in qs})


def test_quantiles_with_most_rows_equal(spark):
    random.seed(1)
    values = [0.0] * 400 + [random.uniform(-50, 900) for _ in range(800)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    got = {r["q"]: r["value"] for r in exact_quantiles(df, "x", [0.1, 0.33, 0.9]).collect()}
    assert got == pytest.approx({q: float(np.quantile(values, q)) for q in (0.1, 0.33, 0.9)})
    assert exact_quantiles(df.where("x > 1e9"), "x", [0.5]).count() == 0


@pytest.mark.parametrize("small", [3, 50])
def test_quantiles_of_real_values_in_one_bin(spark, monkeypatch, small):
    """Brackets narrowed several times: values between 0 and 1, all different but a hot one, by group."""
    monkeypatch.setattr(quantiles, "SMALL_BRACKET", small)
    monkeypatch.setattr(quantiles, "GROUP_ACCURACY", 10)
    monkeypatch.setattr(quantiles, "CUTS", 4)
    rng = random.Random(3)
    values = {g: [rng.random() for _ in range(n)] + [0.5] * (n // 3) for g, n in (("a", 2_000), ("b", 1), (None, 40))}
    data = [(g, v) for g, some in values.items() for v in some] + [("a", None), ("a", float("nan")), ("c", None)]
    df = spark.createDataFrame(data, "grp string, x double").repartition(6)
    qs = [0.0, 0.013, 0.5, 0.77, 1.0]
    got = {(r["grp"], r["q"]): r["value"] for r in exact_quantiles(df, "x", qs, ["grp"]).collect()}
    assert got == pytest.approx({(g, q): float(np.quantile(some, q)) for g, some in values.items() for q in qs})


def test_quantiles_never_order_all_rows_in_one_task(spark, plan, monkeypatch):
    """No plan of the selection has a window; what is gathered per rank is a small bracket."""
    plans = []
    monkeypatch.setattr(quantiles, "stage", lambda df, label: plans.append(plan(df)) or stage(df, label))
    monkeypatch.setattr(quantiles, "SMALL_BRACKET", 3)
    monkeypatch.setattr(quantiles, "ACCURACY", 50)
    df = spark.range(20_000).select((F.rand(5) * 60).alias("x"))
    assert exact_quantiles(df, "x", [0.25, 0.95]).count() == 2
    assert len(plans) >= 6 and not any("Window" in p or "CartesianProduct" in p or "NestedLoop" in p for p in plans)


def test_content_hashes(spark):
    data = [(i, None if i % 4 == 0 else f"v{i % 7}") for i in range(200)] + [(1, "v1")] * 100
    df = spark.createDataFrame(data, "a int, b string")
    shuffled = df.repartition(7, "b").orderBy(F.desc("a"))
    edited = df.withColumn("b", F.when(F.col("a") == 3, "edited").otherwise(F.col("b")))
    fewer = spark.createDataFrame(data[:-1], "a int, b string")
    for form in (hashing.snapshot_hash, hashing.multiset_hash):
        value = lambda frame: form(frame, ["a", "b"]).first()["content_hash"]
        assert value(df) == value(shuffled)
        assert value(df) != value(edited)
        assert value(df) != value(fewer)
        assert value(df) == value(df.na.fill("", ["b"]))
        assert value(df.limit(0)) == "EMPTY"
    flat = hashing.content_hash(df, ["a", "b"]).first()
    assert flat == hashing.snapshot_hash(df, ["a", "b"]).first()
    assert hashing.content_hash(df, ["a", "b"], large=True).first() == hashing.multiset_hash(df, ["a", "b"]).first()


def test_run_metrics(spark):
    df = spark.createDataFrame([(1, None, None, True), (2, "x", "bad", None), (3, None, None, False)], "a int, b string, _corrupt_record string, f boolean")
    row = quality.run_metrics(df, "d", "k", "r", RUN, exclude=["_corrupt_record"], unknown=F.col("f"), extras=quality.counts_json({"f": F.col("f")})).first()
    assert (row["rows_in"], row["rows_out"], row["corrupt_rows"], row["status"]) == (3, 2, 1, "warn")
    assert json.loads(row["nulls_json"]) == {"a": 0, "b": 2, "f": 1}
    assert json.loads(row["columns_json"])[0] == {"name": "a", "type": "int"}
    assert row["unknown_pct"] == pytest.approx(1 / 3) and row["dup_ratio"] is None
    assert json.loads(row["extras_json"]) == {"f": 1}
    clean = quality.run_metrics(df.drop("_corrupt_record"), "d", "k", "r", RUN, rows_in=4).first()
    assert (clean["dup_ratio"], clean["status"]) == (0.25, "ok")
    empty = quality.run_metrics(df.drop("_corrupt_record").limit(0), "d", "k", "r", RUN, rows_in=0, unknown=F.col("f")).first()
    assert empty["rows_out"] == 0 and empty["dup_ratio"] is None and empty["unknown_pct"] is None


def test_dup_ratio(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (None,)], "k int")
    assert tuple(quality.dup_ratio(df, ["k"]).first()) == (4, 2, 0.5)
    assert tuple(quality.dup_ratio(df.limit(0), ["k"]).first()) == (0, 0, None)


def test_priority_topk(spark):
    df = spark.createDataFrame([(c,) for c in ["zz", " lebl", "aa", "LEMD", "aa", "", None, "lebl"]], "icao string")
    assert [r["icao"] for r in topk.priority_topk(df, "icao", n=3).collect()] == ["LEMD", "LEBL", "AA"]
    assert [r["icao"] for r in topk.priority_topk(df, "icao", n=0).collect()] == ["LEMD", "LEBL", "AA", "ZZ"]


def test_daily_states(spark):
    df = spark.createDataFrame(
        [("a", date(2024, 1, 1), float(i), None, i > 90, None) for i in range(100)],
        "icao24 string, event_date_utc date, velocity_mps double, geo_alt_m double, flag_velocity_outlier boolean, flag_alt_outlier boolean",
    )
    row = rollup.daily_states(df, expected=50).first()
    assert (row["pings_count"], row["p95_velocity"], row["p95_altitude"]) == (100, 94.0, None)
    assert (row["pct_velocity_outlier"], row["pct_alt_outlier"], row["coverage_pct"]) == (0.09, None, 200.0)


def test_dim_dates(spark):
    dates = gold.dim_dates(spark, date(2025, 9, 29), RUN, 5, 2)
    assert dates.count() == 1 + 365 * 7
    leap = dates.where("date = date'2024-02-29'").first()
    assert (leap["dow"], leap["quarter"], leap["is_weekend"]) == (3, 1, False)


def flights_frame(spark, data):
    return spark.createDataFrame(
        [(str(i), a, datetime.fromtimestamp(f, timezone.utc), datetime.fromtimestamp(t, timezone.utc)) for i, (a, f, t) in enumerate(data)],
        "flight_id string, icao24 string, first_seen_ts timestamp, last_seen_ts timestamp",
    )


@SMALL
@given(data=st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 5 * 86400), st.integers(0, 6 * 86400)), max_size=25))
def test_turnaround_equals_a_plain_lead(spark, data):
    df = flights_frame(spark, data)
    got = {r["flight_id"]: r["turnaround_s"] for r in measures.turnaround(df).collect()}
    expected = {}
    for plane in "ab":
        own = sorted((f, t, str(i)) for i, (a, f, t) in enumerate(data) if a == plane)
        for (_, t, i), following in zip(own, [*own[1:], None]):
            expected[i] = following[0] - t if following else None
    assert got == expected


def test_one_busy_aircraft_fills_all_ranges(spark, monkeypatch):
    data = [("a", 60 * i, 60 * i + 30) for i in range(4_000)] + [("b", 5, 9)]
    df = flights_frame(spark, data).repartition(5)
    kept = []
    monkeypatch.setattr(measures, "stage", lambda frame, label: kept.append(stage(frame, label)) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["flight_id"]: r["turnaround_s"] for r in measures.turnaround(df).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == {str(i): 30 if i < 3_999 else None for i in range(4_001)}
    sizes = [r["count"] for r in kept[0][0].groupBy("icao24", "_range").count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= 2_000


def test_turnaround_of_ordinary_aircraft_takes_one_shuffle(spark, monkeypatch, plan):
    """no ranges are stored, and ids of hexadecimal digits come back as they were."""
    data = [(f"p{i % 40}", 60 * i, 60 * i + 30) for i in range(400)]
    df = flights_frame(spark, data).withColumn("flight_id", F.sha2("flight_id", 256))
    kept = []
    monkeypatch.setattr(measures, "stage", lambda frame, label: kept.append(label) or stage(frame, label))
    plain = {r["flight_id"]: r["turnaround_s"] for r in measures.turnaround(df).collect()}
    out = measures.turnaround(df, hot=[], hex_ids=True)
    assert not kept and plan(out).count("Exchange") == 1
    assert {r["flight_id"]: r["turnaround_s"] for r in out.collect()} == plain
    assert sum(v is None for v in plain.values()) == 40 and {v for v in plain.values() if v is not None} == {40 * 60 - 30}
    hot = skew.hot_hashes(df.where("icao24 = 'p1'"), ["icao24"])
    again = measures.turnaround(df, hot=hot, hex_ids=True)
    assert kept == ["turnaround-ranges"]
    assert {r["flight_id"]: r["turnaround_s"] for r in again.collect()} == plain


def test_lanes_are_read_once(spark, plan):
    """four numbers a row, not eight."""
    assert plan(hashing.lane_sums(spark.range(5), ["id"])).split("Scan")[0].split("Range")[0].count("conv(") == 4


def test_tasks_are_bounded_unless_the_session_says_so(spark):
    """narrow rows take many times their shuffled bytes in a sort."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    kept = spark.conf.get(key, None)
    try:
        spark.conf.unset(key)
        assert pin_utc(spark).conf.get(key) == "16m"
        spark.conf.set(key, "5m")
        assert pin_utc(spark).conf.get(key) == "5m"
    finally:
        spark.conf.set(key, kept) if kept else spark.conf.unset(key)


def test_reference_golden_counts(spark):
    """49 airports with three repeated codes give 46, five without IATA."""
    codes = [f"LE{i:02d}" for i in range(46)]
    data = [(c, "" if i < 5 else f"A{i:02d}", "city", " Region", "Name", "civil", 1) for i, c in enumerate(codes)]
    data += [(c, f"A{i + 7:02d}", "city", "Region", "Name", "civil", 1) for i, c in enumerate(codes[7:10])]
    raw = spark.createDataFrame(data, "icao string, iata string, city string, region string, name string, type string, _ingest_ts int")
    out = silver.silver_ref_airports(raw, RUN)
    assert out.count() == 46 and out.where("iata is null").count() == 5
    ratio = quality.dup_ratio(silver.clean_ref_airports(raw), ["icao"]).first()["dup_ratio"]
    assert round(ratio, 5) == 0.06122


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("fits", [True, False])
def test_skew_join_equals_the_plain_join(spark, rows, monkeypatch, how, fits):
    left = spark.range(0, 900, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 50).alias("k"),
        F.lit("x").alias("copy"),
    )
    right = spark.createDataFrame([(7, "a"), (7, "b"), (3, "c"), (900, "d"), (None, "n")], "k long, v string")
    hot = skew.hot_hashes(left, ["k"], share=0.05)
    expected = {r[0] for r in spark.createDataFrame([(7,), (None,)], "k long").select(F.xxhash64("k")).collect()}
    assert set(hot) == expected
    monkeypatch.setattr(skew, "fits_broadcast", lambda few: fits)
    got = skew.skew_join(left, right, ["k"], how, hot=hot)
    assert rows(got) == rows(left.join(right, "k", how))


def test_hot_is_what_makes_a_task_uneven(spark):
    even = spark.range(5000).withColumn("k", F.col("id") % 1000)
    assert skew.hot_hashes(even, ["k"]) == []
    assert len(skew.hot_hashes(even.withColumn("k", F.lit(1)), ["k"])) == 1
    assert skew.hot_share(even) == 0.5
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    try:
        assert skew.hot_share(even) == 0.002
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
