"""Files to gold on temporary folders, in batch and as streams."""

import gzip
import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from contrail import schemas
from contrail.operators import quality
from contrail.plans import gold, lake as jobs, silver
from contrail.plans.lake import Lake
from contrail.sources import files, ledger, tables
from contrail.streaming.ingest import stream_files
from contrail.streaming.upsert import stream_upsert

T0 = 1_704_067_200  # 2024-01-01 00:00:00 UTC


def put(root, name, records, *raw_lines):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [json.dumps(r) for r in records] + list(raw_lines)
    with gzip.open(path, "wt") as out:
        out.write("".join(line + "\n" for line in lines))


def state(plane, second, velocity=100.0):
    return {"icao24": plane, "time_position": T0 + second, "last_contact": T0, "velocity": velocity, "geo_altitude": 900.0}


def flight(plane, dep, arr, first=0, last=3600, callsign="ibe12 "):
    return {"icao24": plane, "firstSeen": T0 + first, "lastSeen": T0 + last, "estDepartureAirport": dep, "estArrivalAirport": arr, "callsign": callsign}


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


@pytest.fixture
def raw(tmp_path):
    return tmp_path / "raw"


def ingest_states(spark, lake, raw, run, ts, **options):
    return jobs.ingest_files(spark, lake, "states", str(raw / "states"), schemas.STATES, run, ts, **options)


def test_scan_modes(spark, tmp_path):
    put(tmp_path, "f.json.gz", [state("a", 1)], "{broken", '{"icao24": "b", "velocity": "fast"}')
    put(tmp_path, "empty.json.gz", [])
    got = files.read_ndjson(spark, str(tmp_path), schemas.STATES).collect()
    corrupt = {r["_corrupt_record"] for r in got}
    assert len(got) == 3 and corrupt == {None, "{broken", '{"icao24": "b", "velocity": "fast"}'}
    (tmp_path / "payload").mkdir()
    (tmp_path / "payload" / "p.json").write_text(json.dumps({"time": 5, "states": [["abc", "x", "Spain", 1, 2, 3.5, None, None, True, 250.25, 0, 0, None, 9, None, False, 0]]}, indent=2))
    decoded = files.decode_states(files.read_state_payloads(spark, str(tmp_path / "payload")), keep=["time"]).first()
    assert (decoded["time"], decoded["velocity"], decoded["on_ground"], decoded["sensors"]) == (5, 250.25, True, None)


def test_states_to_gold(spark, lake, raw, at, rows):
    put(raw, "states/date=2024-01-01/states_x_20240101T010000Z.json.gz", [state(" ab1 ", 5), state("AB1", 5, 400.0), state("c", 9)], "{oops")
    put(raw, "states/date=2024-01-02/states_x.json.gz", [state("c", 86400 + 5)])
    # The limit is one of a batch: one call takes all.
    assert ingest_states(spark, lake, raw, "r1", at(1), max_files=1) == 2
    assert ingest_states(spark, lake, raw, "r3", at(3)) == 0

    bronze = tables.read(spark, lake.table("bronze", "states"))
    assert bronze.count() == 4 and bronze.where("download_ts is null").count() == 1
    assert rows(bronze.select("download_date").distinct()) == [(date(2024, 1, 1),), (date(2024, 1, 2),)]
    bad = tables.read(spark, lake.table("quarantine", "states"))
    assert rows(bad, "_corrupt_record") == [("{oops",)]
    metrics = tables.read(spark, lake.metrics("bronze"))
    assert rows(metrics, "ingest_id", "rows_in", "rows_out", "corrupt_rows", "status") == [("r1", 4, 3, 1, "warn"), ("r1.1", 1, 1, 0, "ok")]

    assert jobs.refresh_states(spark, lake, "s1", at(4)) == 2
    assert jobs.refresh_states(spark, lake, "s2", at(5)) == 0
    states = tables.read(spark, lake.table("silver", "states"))
    assert sorted(states.columns) == sorted(silver.STATES_COLUMNS)
    assert rows(states.groupBy("icao24").count()) == [("AB1", 1), ("C", 2)]
    quality_row = tables.read(spark, lake.metrics("silver")).first()
    assert (quality_row["rows_in"], quality_row["rows_out"], quality_row["dup_ratio"]) == (4, 3, 0.25)
    assert quality_row["freshness_lag_minutes"] == 180.0

    jobs.refresh_fact_states(spark, lake, "g1", at(6))
    facts = tables.read(spark, lake.table("gold", "fact_states"))
    before = rows(facts, "icao24", "event_date_utc", "pings_count")
    assert before == [("AB1", date(2024, 1, 1), 1), ("C", date(2024, 1, 1), 1), ("C", date(2024, 1, 2), 1)]

    # A late file for the first day: only that date is computed again.
    put(raw, "states/date=2024-01-01/states_x_20240101T230000Z.json.gz", [state("c", 60), state("c", 9)])
    ingest_states(spark, lake, raw, "r4", at(7))
    jobs.refresh_states(spark, lake, "s3", at(8))
    jobs.refresh_fact_states(spark, lake, "g2", at(9))
    facts = tables.read(spark, lake.table("gold", "fact_states"))
    got = rows(facts, "icao24", "event_date_utc", "pings_count", "_gold_run_id")
    assert got == [("AB1", date(2024, 1, 1), 1, "g2"), ("C", date(2024, 1, 1), 2, "g2"), ("C", date(2024, 1, 2), 1, "g1")]


def test_lost_run_is_finished_once(spark, lake, raw, at, monkeypatch):
    put(raw, "states/date=2024-01-01/a.json.gz", [state("a", 1)])
    put(raw, "states/no_date/b.json.gz", [state("b", 1)])

    real = jobs._record_run

    def lose(*args, **kwargs):
        if ledger.PROCESSING not in args:
            raise RuntimeError("lost after the write")
        real(*args, **kwargs)

    monkeypatch.setattr(jobs, "_record_run", lose)
    with pytest.raises(RuntimeError):
        ingest_states(spark, lake, raw, "r1", at(1))
    monkeypatch.setattr(jobs, "_record_run", real)
    put(raw, "states/date=2024-01-03/c.json.gz", [state("c", 1)])
    assert ingest_states(spark, lake, raw, "r2", at(1, day=5)) == 1
    bronze = tables.read(spark, lake.table("bronze", "states"))
    got = sorted((r["icao24"], r["_ingest_id"], r["download_date"]) for r in bronze.collect())
    assert got == [("a", "r1", date(2024, 1, 1)), ("b", "r1", date(2024, 1, 1)), ("c", "r2", date(2024, 1, 3))]


def write_references(tmp_path, extra=""):
    airports = tmp_path / "airports.csv"
    airports.write_text("city,region,icao,iata,name,type\n" "madrid, Madrid,LEMD,MAD,barajas,civil\n" 'a,b,lebl,BCN,"el prat",Civil\n' "x,y,LEXX,,none,civil\n" "madrid,Madrid,LEMD,MAD,barajas,civil\n" + extra)
    airlines = tmp_path / "airlines.csv"
    airlines.write_text("prefix,airline\nIBE,iberia\n VLG ,vueling\n")
    return str(airlines), str(airports)


def test_flights_to_export(spark, lake, raw, tmp_path, at, rows):
    airlines, airports = write_references(tmp_path)
    args = ("ref_airports", airports, schemas.REF_AIRPORTS)
    assert jobs.ingest_snapshot(spark, lake, *args, "b1", at(1))
    assert not jobs.ingest_snapshot(spark, lake, *args, "b2", at(1))
    write_references(tmp_path, "z,z,LEZZ,ZZZ,zz,civil\n")
    assert jobs.ingest_snapshot(spark, lake, *args, "b3", at(2))
    assert jobs.ingest_snapshot(spark, lake, "ref_airlines_prefixes", airlines, schemas.REF_AIRLINES, "b4", at(2))
    first = jobs.refresh_reference(spark, lake, "ref_airports", "s1", at(3))
    assert jobs.refresh_reference(spark, lake, "ref_airports", "s2", at(4)) == first
    jobs.refresh_reference(spark, lake, "ref_airlines_prefixes", "s1", at(3))
    assert tables.read(spark, lake.table("silver", "ref_airports")).count() == 4

    shared = flight("p1", "LEMD", "LEBL")
    put(raw, "dep/tag=lemd/date=2024-01-01/f_20240101T050000Z.json.gz", [shared, flight("p2", "LEMD", None, 60), shared])
    put(raw, "arr/tag=lebl/date=2024-01-01/f_20240101T060000Z.json.gz", [shared, flight("p3", "LFPG", "LEBL", 90, callsign="  ")])
    for feed, folder in (("flights_departure", "dep"), ("flights_arrival", "arr")):
        jobs.ingest_files(spark, lake, feed, str(raw / folder), schemas.FLIGHTS, f"{folder}1", at(5), tagged=True)
        assert jobs.refresh_flights(spark, lake, feed, f"{folder}s", at(6)) == 1
    tags = tables.read(spark, lake.table("bronze", "flights_arrival")).select("tag").distinct()
    assert rows(tags) == [("LEBL",)]
    dep = tables.read(spark, lake.table("silver", "flights_departure"))
    assert sorted(dep.columns) == sorted(silver.FLIGHTS_COLUMNS) and dep.count() == 2

    for run in ("g1", "g2"):
        jobs.refresh_fact_flights(spark, lake, run, at(7))
    facts = tables.read(spark, lake.table("gold", "fact_flights"))
    assert len(facts.columns) == 36
    got = rows(facts, "icao24", "airline_name", "dep_iata", "arr_iata", "unknown_dep", "unknown_arr")
    assert got == [("P1", "Iberia", "MAD", "BCN", False, False), ("P2", "Iberia", "MAD", None, False, True), ("P3", None, None, "BCN", True, False)]

    jobs.refresh_dimensions(spark, lake, "g3", at(8), date(2024, 1, 1), 1, 1)
    jobs.refresh_dimensions(spark, lake, "g4", at(9), date(2024, 1, 1), 1, 1)
    assert rows(tables.read(spark, lake.table("gold", "dim_airlines")), "airline_prefix", "airline_name") == [("IBE", "Iberia")]
    assert tables.read(spark, lake.table("gold", "dim_dates")).count() == 731
    assert rows(tables.read(spark, lake.table("gold", "dim_airports")), "icao", "_gold_run_id")[0] == ("LEBL", "g4")

    # fact_states is needed for the full export.
    put(raw, "states/date=2024-01-01/s.json.gz", [state("p1", 5)])
    ingest_states(spark, lake, raw, "r", at(5))
    jobs.refresh_states(spark, lake, "r", at(6))
    jobs.refresh_fact_states(spark, lake, "r", at(7))
    out = str(tmp_path / "bi")
    jobs.export_gold(spark, lake, out, single_file=True)
    assert {name: tables.read(spark, f"{out}/{name}").count() for name in jobs.EXPORTED} == {
        "fact_flights": 3, "fact_states": 1, "dim_airports": 4, "dim_airlines_prefixes": 2, "dim_airlines": 1, "dim_dates": 731,
    }
    jobs.register_all(spark, lake, "gold", jobs.EXPORTED)
    assert spark.table("gold.fact_flights").count() == 3
    runs = ledger.read_manifest(spark, lake.manifest("gold"))
    assert runs.where("status = 'done' and source_file like 'run://%'").count() == 2 + 2 * 4 + 1


def test_streams(spark, lake, raw, tmp_path, rows):
    now = lambda: datetime(2024, 1, 9, tzinfo=timezone.utc)

    def run():
        query = stream_files(spark, lake, "states", str(raw / "states"), schemas.STATES, str(tmp_path / "cp1"), max_files=1, now=now)
        query.awaitTermination()
        query = stream_upsert(
            spark, lake.table("bronze", "states"), lake.table("silver", "states"),
            lambda batch: silver.silver_states(batch, now()), silver.STATES_KEY, ["event_date_utc"],
            ["_ingest_ts", "_source_file"], str(tmp_path / "cp2"), max_files=1,
        )
        query.awaitTermination()
        return tables.read(spark, lake.table("bronze", "states")).count(), tables.read(spark, lake.table("silver", "states")).count()

    put(raw, "states/date=2024-01-02/states_x_20240102T010000Z.json.gz", [state("a", 86400), state("a", 5)], "{bad")
    put(raw, "states/date=2024-01-01/states_x_20240101T010000Z.json.gz", [state("a", 5), state("b", 6)])
    assert run() == (4, 3)
    assert run() == (4, 3)
    put(raw, "states/date=2024-01-03/states_x_20240103T010000Z.json.gz", [state("b", 6), state("d", 7)])
    assert run() == (6, 4)
    batch = silver.silver_states(tables.read(spark, lake.table("bronze", "states")), now())
    key = ["icao24", "_source_file"]
    assert rows(tables.read(spark, lake.table("silver", "states")), *key) == rows(batch, *key)
    assert tables.read(spark, lake.table("quarantine", "states")).count() == 1
    done = ledger.read_manifest(spark, lake.manifest("bronze")).where("status = 'done'")
    assert done.count() == 2 * 3  # three batches of one file each


def test_a_second_checkpoint_takes_nothing_twice_and_overwrites_nothing(spark, lake, raw, tmp_path):
    put(raw, "states/date=2024-01-01/a.json.gz", [state("a", 5)])
    for attempt in ("cp1", "cp2"):
        query = stream_files(spark, lake, "states", str(raw / "states"), schemas.STATES, str(tmp_path / attempt))
        query.awaitTermination()
    assert tables.read(spark, lake.table("bronze", "states")).count() == 1
    assert gold.STATES_KEY == ("icao24", "event_date_utc")


def test_two_sources_and_both_modes_share_a_table(spark, lake, raw, tmp_path, at, rows):
    put(raw, "one/date=2024-01-01/a.json.gz", [state("a", 5)])
    put(raw, "two/date=2024-01-01/b.json.gz", [state("b", 5)])
    for source in ("one", "two"):
        stream_files(spark, lake, "states", str(raw / source), schemas.STATES, str(tmp_path / source)).awaitTermination()
    put(raw, "one/date=2024-01-01/c.json.gz", [state("c", 5)])
    ingest = lambda run, hour: jobs.ingest_files(spark, lake, "states", str(raw), schemas.STATES, run, at(hour))
    assert ingest("0001", 1) == 1 and ingest("0002", 2) == 0
    stream_files(spark, lake, "states", str(raw / "one"), schemas.STATES, str(tmp_path / "one")).awaitTermination()
    assert rows(tables.read(spark, lake.table("bronze", "states")), "icao24") == [("a",), ("b",), ("c",)]
    jobs.refresh_states(spark, lake, "0003", at(3))
    put(raw, "one/date=2024-01-01/d.json.gz", [state("d", 5)])
    ingest("run-3", 4)
    jobs.refresh_states(spark, lake, "run-5", at(5))
    got = rows(tables.read(spark, lake.table("silver", "states")), "icao24", "_ingest_id")
    assert [g[0] for g in got] == ["A", "B", "C", "D"] and ("C", "0001") in got and ("D", "run-3") in got


def test_gold_takes_a_silver_run_with_an_early_time(spark, lake, raw, at, rows, plan):
    put(raw, "states/date=2024-01-01/a.json.gz", [state("a", 5)])
    ingest_states(spark, lake, raw, "r1", at(1))
    jobs.refresh_states(spark, lake, "s1", at(1))
    jobs.refresh_fact_states(spark, lake, "g1", at(3))
    put(raw, "states/date=2024-01-02/b.json.gz", [state("b", 86400)])
    ingest_states(spark, lake, raw, "r2", at(2))
    jobs.refresh_states(spark, lake, "s2", at(2))
    jobs.refresh_fact_states(spark, lake, "g2", at(4))
    facts = tables.read(spark, lake.table("gold", "fact_states"))
    assert rows(facts, "icao24", "_gold_run_id") == [("A", "g1"), ("B", "g2")]
    assert jobs._new_runs(spark, lake, "gold.fact_states", ["states"]) == {"states": []}
    assert "PartitionFilters: [" in plan(jobs._days_of(spark, lake, "states", ["s2"], "event_date_utc"))


def test_a_repeated_run_leaves_one_metrics_row(spark, lake, raw, at, monkeypatch):
    put(raw, "states/date=2024-01-01/a.json.gz", [state("a", 5)])
    ingest_states(spark, lake, raw, "r1", at(1))
    real = jobs._record_run
    monkeypatch.setattr(jobs, "_record_run", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        jobs.refresh_states(spark, lake, "s1", at(2))
    monkeypatch.setattr(jobs, "_record_run", real)
    jobs.refresh_states(spark, lake, "s1", at(2))
    assert tables.read(spark, lake.metrics("silver")).count() == 1


def test_gold_of_an_empty_lake_has_no_rows_and_takes_later_runs(spark, lake, raw, tmp_path, at, rows):
    jobs.refresh_fact_states(spark, lake, "g0", at(1))
    jobs.refresh_fact_flights(spark, lake, "g0", at(1))
    for name, key in (("fact_states", "icao24"), ("fact_flights", "flight_id")):
        assert rows(tables.read(spark, lake.table("gold", name)), key) == []
    put(raw, "states/date=2024-01-01/a.json.gz", [state("a", 5), state("a", 9)])
    ingest_states(spark, lake, raw, "r1", at(2))
    jobs.refresh_states(spark, lake, "s1", at(3))
    jobs.refresh_fact_states(spark, lake, "g1", at(4))
    assert rows(tables.read(spark, lake.table("gold", "fact_states")), "icao24", "pings_count") == [("A", 2)]


def test_metrics_come_from_the_pass_that_writes(spark, lake, raw, at, monkeypatch):
    """No job counts or aggregates a frame for its metrics; the row equals the separate aggregate."""
    put(raw, "states/date=2024-01-01/a.json.gz", [state("a", 5), state("a", 5, 400.0), state("b", 9), state(None, 1)], "{oops")
    frames = []
    observed = quality.ObservedRun.__init__
    monkeypatch.setattr(quality.ObservedRun, "__init__", lambda self, df, *a, **k: frames.append((df, a, k)) or observed(self, df, *a, **k))
    monkeypatch.setattr(quality, "run_metrics", lambda *a, **k: pytest.fail("a pass for metrics"))
    ingest_states(spark, lake, raw, "r1", at(1))
    jobs.refresh_states(spark, lake, "s1", at(2))
    jobs.refresh_fact_states(spark, lake, "g1", at(3))
    monkeypatch.undo()
    assert len(frames) == 3
    for layer, (df, args, options) in zip(("bronze", "silver", "gold"), frames, strict=True):
        stored = tables.read(spark, lake.metrics(layer)).select(*[f.name for f in df.sparkSession.createDataFrame([], schemas.METRICS).schema]).first()
        if counted := options.pop("counted", None):
            options["rows_in"] = df.agg(F.sum(counted)).first()[0]
        assert stored == quality.run_metrics(df.drop(jobs.COUNTED), *args, **options).first()
    assert tables.read(spark, lake.metrics("silver")).first()["rows_in"] == 3
