"""Stored tables: overwrite, upsert, moving keys, ledgers, export, catalog."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from contrail.operators import hashing, merge as merging
from contrail.session import path_exists, shared_dir
from contrail.sources import files, ledger, sums, tables

DDL = "k int, d date, v string, t int"


def frame(spark, *data):
    return spark.createDataFrame([(k, date(2024, 1, d), v, t) for k, d, v, t in data], DDL)


def test_replace_partitions_leaves_the_others(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.replace_partitions(frame(spark, (1, 1, "a", 1), (2, 2, "b", 1)), path, ["d"])
    tables.replace_partitions(frame(spark, (3, 2, "c", 1)), path, ["d"])
    tables.replace_partitions(frame(spark, (3, 2, "c", 1)), path, ["d"])
    assert rows(tables.read(spark, path), "k", "v") == [(1, "a"), (3, "c")]
    tables.append(frame(spark, (4, 1, "d", 1)).withColumn("extra", F.lit(5)), path, ["d"])
    assert rows(tables.read(spark, path), "k", "extra") == [(1, None), (3, None), (4, 5)]


def test_upsert_moves_a_key_between_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    first = frame(spark, (1, 1, "a", 1), (2, 1, "b", 1), (3, 2, "c", 1), (4, 3, "x", 1))
    tables.upsert_table(first, path, ["k"], ["d"])
    # 1 moves and leaves its partition to 2; 3 moves and empties its partition.
    change = frame(spark, (1, 4, "A", 2), (3, 4, "C", 2), (5, 1, "e", 2))
    for _ in range(2):
        tables.upsert_table(change, path, ["k"], ["d"])
        got = rows(tables.read(spark, path).withColumn("d", F.day("d")), "k", "d", "v")
        assert got == [(1, 4, "A"), (2, 1, "b"), (3, 4, "C"), (4, 3, "x"), (5, 1, "e")]


def test_moving_keys_read_candidate_partitions_only(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    tables.upsert_table(frame(spark, *[(k, 1 + k % 20, "a", 1) for k in range(200)]), path, ["k"], ["d"])
    seen = []
    among = tables.among
    monkeypatch.setattr(tables, "among", lambda df, values, cols: seen.append(sorted(v.d.day for v in values)) or among(df, values, cols))
    files_of = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("d=*/*.parquet")}
    before = files_of()
    for _ in range(2):
        tables.upsert_table(frame(spark, (3, 25, "moved", 2), (24, 5, "same", 2), (999, 7, "new", 2)), path, ["k"], ["d"])
    # Key 3 was on the 4th; then the digest knows that it is on the 25th.
    assert seen == [[4, 5, 7, 25], [5, 7, 25]]
    kept = {f for f in before if f.exists()}
    assert {f.parent.name[-2:] for f in before} - {f.parent.name[-2:] for f in kept} == {"04", "05", "07"}
    got = rows(tables.read(spark, path).where("v <> 'a'").withColumn("d", F.day("d")), "k", "d", "v")
    assert got == [(24, 5, "same"), (3, 25, "moved"), (999, 7, "new")] and tables.read(spark, path).count() == 201
    digest = tables.candidate_partitions(frame(spark, (3, 1, "", 1)), path, ["k"], ["d"])
    plan = digest._jdf.queryExecution().executedPlan().toString()
    assert "_keys" in plan and "/t/d=" not in plan and rows(digest.select(F.day("d"))) == [(25,)]


def test_kept_sums_equal_the_hash_of_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    hashed = ["k", "d", "v"]
    whole = lambda: hashing.multiset_hash(tables.read(spark, path), hashed).first()
    data = frame(spark, *[(k, 1 + k % 20, "a", 1) for k in range(200)]).withColumn("d", F.when(F.col("k") % 9 > 0, F.col("d")))
    tables.upsert_table(data, path, ["k"], ["d"])
    sums.build(spark, path, hashed, ["d"])
    assert sums.content_hash(spark, path).first() == whole()
    read = []
    among = tables.among
    monkeypatch.setattr(tables, "among", lambda df, values, cols: read.append(len(values)) or among(df, values, cols))
    # Keys move to another day, to none, and leave the 25th empty again.
    for change in ((3, 25, "b"), (7, 8, "c")), ((3, 2, "b"), (500, 25, "x")), ((500, 1, "y"), (3, 2, "z")):
        rewritten = tables.upsert_table(frame(spark, *[(*c, 2) for c in change]), path, ["k"], ["d"])
        sums.refresh(spark, path, hashed, ["d"], rewritten)
        assert sums.content_hash(spark, path).first() == whole()
    assert max(read) <= 4 and len(read) == 6
    sums.refresh(spark, path, hashed, ["d"], [])
    empty = str(tmp_path / "e")
    tables.overwrite(tables.read(spark, path).limit(0), empty, ["d"])
    sums.build(spark, empty, hashed, ["d"])
    assert sums.content_hash(spark, empty).first()["content_hash"] == "EMPTY"


def test_digest_outlives_a_lost_run_and_no_other_write(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    tables.upsert_table(frame(spark, (1, 1, "a", 1), (2, 2, "b", 1)), path, ["k"], ["d"])
    move = frame(spark, (1, 3, "A", 2))
    tables.upsert_table(frame(spark, (2, 2, "b", 2)), path, ["k"], ["d"])
    replace = tables._replace

    def lost(*_):
        raise RuntimeError("lost")

    for broken in (lost, lambda *a: replace(*a) or lost()):
        monkeypatch.setattr(tables, "_replace", broken)
        with pytest.raises(RuntimeError, match="lost"):
            tables.upsert_table(move, path, ["k"], ["d"])
    monkeypatch.setattr(tables, "_replace", replace)
    tables.upsert_table(move, path, ["k"], ["d"])
    assert rows(tables.read(spark, path), "k", "v") == [(1, "A"), (2, "b")]
    # A write that knows no keys removes the digest; the next upsert builds it anew.
    tables.append(frame(spark, (3, 9, "c", 1)), path, ["d"])
    assert not (tmp_path / "t" / "_keys").exists()
    tables.upsert_table(frame(spark, (3, 1, "C", 2)), path, ["k"], ["d"])
    assert rows(tables.read(spark, path), "k", "v") == [(1, "A"), (2, "b"), (3, "C")]


@pytest.mark.parametrize("kind", ["string", "timestamp", "boolean", "double"])
def test_keys_leave_partitions_of_any_name(spark, tmp_path, rows, kind):
    values = {
        "string": ["a b", "x/y: 50%", None, "é=[1]"], "timestamp": ["2024-01-01 10:00:00", "2024-01-01 10:30:00.5", None],
        "boolean": ["true", "false", None], "double": ["1.5", "-0.25", None],
    }[kind]
    path = str(tmp_path / "t")
    data = lambda shift: spark.createDataFrame(
        [(i, values[(i + shift) % len(values)]) for i in range(2 if shift else 4)], "k int, p string"
    ).withColumn("p", F.col("p").cast(kind))
    tables.upsert_table(data(0).where("k < 2"), path, ["k"], ["p"])
    tables.upsert_table(data(1), path, ["k"], ["p"])
    got = tables.read(spark, path).select("k", F.col("p").cast("string"))
    assert rows(got) == rows(data(1).select("k", F.col("p").cast("string")))


def test_upsert_reads_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.upsert_table(frame(spark, (1, 1, "a", 1), (2, 2, "b", 1)), path, ["k", "d"], ["d"])
    untouched = next((tmp_path / "t" / "d=2024-01-02").glob("*.parquet"))
    tables.upsert_table(frame(spark, (1, 1, "A", 2)), path, ["k", "d"], ["d"], key_fixes_partition=True)
    assert untouched.exists()
    touched = frame(spark, (1, 1, "A", 2)).select("d").distinct()
    scan = tables.restrict(tables.read(spark, path), touched, ["d"])
    assert "PartitionFilters: [isnotnull(d" in scan._jdf.queryExecution().executedPlan().toString() or "PartitionFilters: [(d" in scan._jdf.queryExecution().executedPlan().toString()


def test_upsert_newest_first_write_and_late_row(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.upsert_table(frame(spark, (1, 1, "new", 5), (1, 1, "old", 3)), path, ["k"], ["d"], newest_by=["t"])
    tables.upsert_table(frame(spark, (1, 2, "late", 4), (2, 2, "b", 1)), path, ["k"], ["d"], newest_by=["t"])
    assert rows(tables.read(spark, path), "k", "v") == [(1, "new"), (2, "b")]
    tables.upsert_table(frame(spark, (1, 2, "newer", 6)), path, ["k"], ["d"], newest_by=["t"])
    assert rows(tables.read(spark, path), "k", "v") == [(1, "newer"), (2, "b")]


def test_failed_upsert_leaves_the_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.upsert_table(frame(spark, (1, 1, "a", 1)), path, ["k"])
    with pytest.raises(ValueError):
        tables.upsert_table(frame(spark, (2, 1, "a", 1), (2, 1, "b", 1)), path, ["k"])
    assert rows(tables.read(spark, path), "k") == [(1,)]
    tables.upsert_table(frame(spark, (1, 1, "z", 1)), path, ["k"])
    assert rows(tables.read(spark, path), "k", "v") == [(1, "z")]


def test_scratch_is_cleared(spark, tmp_path):
    tables.upsert_table(frame(spark, (1, 1, "a", 1)), str(tmp_path / "t"), ["k"])
    left = list(map(str, tmp_path.glob("**/source-*")))
    assert left == [] and path_exists(spark, shared_dir(spark))


def test_file_listing_and_hash(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.csv").write_text("x\n1\n")
    (tmp_path / "two.csv").write_text("x\n1\n")
    (tmp_path / "three.txt").write_text("")
    found = files.list_files(spark, str(tmp_path), "*.csv")
    assert found.count() == 2
    (everything,) = ledger.batches(found)
    hashes = files.file_hashes(spark, everything).select("file_hash").distinct()
    assert [r[0] for r in hashes.collect()] == ["dc3ba59be5d893be2c69ea202014fe78"]
    assert [b[0].rsplit("/", 1)[1] for b in ledger.batches(found, 1)] == ["one.csv", "two.csv"]


def test_no_upsert_drops_a_value(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.upsert_table(frame(spark, (1, 1, "a", 1)), path, ["k"], ["d"])
    wider = lambda k, w: frame(spark, (k, 1, "b", 1)).withColumn("w", F.lit(w))
    tables.upsert_table(wider(3, "W3"), path, ["k"], ["d"])
    tables.upsert_table(wider(4, "W4"), path, ["k"], ["d"])
    tables.upsert_table(frame(spark, (3, 1, "c", 2)), path, ["k"], ["d"])
    assert rows(tables.read(spark, path), "k", "v", "w") == [(1, "a", None), (3, "c", "W3"), (4, "b", "W4")]
    with pytest.raises(ValueError, match="w is string"):
        tables.append(wider(5, 5), path, ["d"])


def test_null_keys_are_refused_and_never_multiply(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.upsert_table(frame(spark, (1, 1, "a", 1)), path, ["k"])
    with pytest.raises(ValueError, match="NULL"):
        tables.upsert_table(frame(spark, (None, 1, "n", 1)), path, ["k"])
    source = frame(spark, (None, 1, "n", 1), (1, 1, "z", 2))
    once = merging.upsert(frame(spark, (1, 1, "a", 1)), source, ["k"])
    assert merging.upsert(once, source, ["k"]).count() == 2
    every = {c: F.col(f"s.{c}") for c in ("d", "v", "t")}
    once = merging.merge(frame(spark, (1, 1, "a", 1)), source, ["k"], every)
    assert rows(merging.merge(once, source, ["k"], every), "k", "v") == [(1, "z"), (None, "n")]


def test_partition_values_keep_their_type(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    for run in ("0001", "0002", "run-3"):
        tables.append(spark.range(1).withColumn("run", F.lit(run)), path, ["run"])
    assert rows(tables.read(spark, path), "run") == [("0001",), ("0002",), ("run-3",)]


def test_manifest(spark, tmp_path, at, rows):
    path = str(tmp_path / "manifest")
    assert ledger.read_manifest(spark, path).isEmpty()
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "source_file string")
    ledger.record(ledger.entries(names("f1", "f2"), "a", "r1", at(1), ledger.PROCESSING), path)
    ledger.record(ledger.entries(names("f1"), "a", "r1", at(2)), path)
    ledger.record(ledger.entries(names("f1"), "b", "r2", at(3)), path)
    manifest = ledger.read_manifest(spark, path)
    assert rows(manifest, "dataset", "source_file", "status") == [("a", "f1", "done"), ("a", "f2", "processing"), ("b", "f1", "done")]
    assert rows(ledger.new_files(names("f1", "f2", "f3"), manifest, "a")) == [("f2",), ("f3",)]
    assert rows(ledger.unfinished(manifest, "a"), "source_file") == [("f2",)]


def test_a_record_adds_its_own_entries_only(spark, tmp_path, at, rows):
    path = tmp_path / "manifest"
    names = lambda *n: spark.createDataFrame([(x,) for x in n], "source_file string")
    stored = lambda: {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    ledger.record(ledger.entries(names("f1", "f2", "f3"), "a", "r1", at(1), ledger.PROCESSING), str(path))
    before = stored()
    ledger.record(ledger.entries(names("f1", "f3"), "a", "r1", at(2)), str(path))
    after = stored()
    assert before.items() <= after.items() and len(after) > len(before)
    assert ledger.read_log(spark, str(path)).count() == 5
    # Equal entries change nothing, one that differs does, also back to what was before.
    ledger.record(ledger.entries(names("f1"), "a", "r1", at(9)), str(path))
    in_force = lambda: rows(ledger.read_manifest(spark, str(path)).select("source_file", "status", F.unix_timestamp("processed_ts")))
    hour = lambda h: int(at(h).timestamp())
    assert in_force() == [("f1", "done", hour(2)), ("f2", "processing", hour(1)), ("f3", "done", hour(2))]
    ledger.record(ledger.entries(names("f3"), "a", "r1", at(4), ledger.FAILED), str(path))
    ledger.record(ledger.entries(names("f3"), "a", "r1", at(5)), str(path))
    ledger.record(ledger.entries(names("f1"), "b", "r1", at(5)), str(path))
    wanted = [("f1", "done", hour(2)), ("f1", "done", hour(5)), ("f2", "processing", hour(1)), ("f3", "done", hour(5))]
    assert in_force() == wanted
    ledger.compact(spark, str(path), "a")
    ledger.compact(spark, str(path), "a")
    assert in_force() == wanted and ledger.read_log(spark, str(path)).count() == 4
    with pytest.raises(Exception, match="NULL in ledger key"):
        ledger.record(ledger.entries(spark.createDataFrame([(None,)], "source_file string"), "a", "r1", at(1)), str(path))


def test_change_gates(spark, at):
    ddl = "dataset string, source_file string, ingest_id string, processed_ts timestamp, status string, file_hash string, version string"
    log = spark.createDataFrame(
        [
            ("d", "same", "r1", at(1), "done", "old", "v1"),
            ("d", "same", "r2", at(2), "done", "h", "v1"),
            ("d", "same", "r3", at(3), "failed", "zzz", "v1"),
            ("d", "edited", "r1", at(1), "done", "h", "v1"),
            ("d", "failed", "r1", at(1), "failed", "h", "v1"),
            ("d", "nohash", "r1", at(1), "done", None, "v1"),
        ],
        ddl,
    )
    names = ["same", "edited", "failed", "nohash", "unseen"]
    hashes = {"edited": "h2"}
    now = spark.createDataFrame([("d", n, hashes.get(n, "h"), "v1") for n in names], "dataset string, source_file string, file_hash string, version string")
    gate = {r["source_file"]: r["needs_processing"] for r in ledger.change_gate(now, log).collect()}
    assert gate == {"same": False, "edited": True, "failed": True, "nohash": True, "unseen": True}
    v2 = now.withColumn("version", F.lit("v2"))
    assert all(r["needs_processing"] for r in ledger.change_gate(v2, log, with_version=True).collect())
    by_version = {r["source_file"]: r["needs_processing"] for r in ledger.version_gate(now.drop("file_hash"), log).collect()}
    assert by_version == {"same": False, "edited": False, "failed": True, "nohash": False, "unseen": True}


def test_export_and_catalog(spark, tmp_path):
    path, out = str(tmp_path / "t"), str(tmp_path / "out")
    tables.replace_partitions(frame(spark, (1, 1, "a", 1), (2, 2, "b", 1)), path, ["d"])
    tables.export(tables.read(spark, path), out, single_file=True)
    tables.export(tables.read(spark, path), out, single_file=True)
    assert len(list((tmp_path / "out").glob("*.parquet"))) == 1
    assert tables.read(spark, out).count() == 2
    tables.register(spark, path, "layer_x", "t")
    tables.register(spark, path, "layer_x", "t")
    assert spark.table("layer_x.t").where("d = date'2024-01-02'").count() == 1
    tables.ensure(spark, str(tmp_path / "empty"), DDL)
    assert tables.read(spark, str(tmp_path / "empty")).columns == ["k", "d", "v", "t"]


def test_listed_files_keep_their_partition(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    tables.replace_partitions(frame(spark, (1, 1, "a", 1), (2, 2, "b", 1), (3, 3, "c", 1)), path, ["d"])
    listed = files.list_files(spark, path, "*.parquet").where(F.col("source_file").rlike("d=2024-01-0[12]"))
    got = files.read_parquet_files(spark, ledger.batches(listed)[0], path)
    assert rows(got, "k", "d") == [(1, date(2024, 1, 1)), (2, date(2024, 1, 2))]


def test_a_large_source_file_is_many_tasks(spark, tmp_path, monkeypatch):
    """the source of an upsert is stored in several files, whatever it was read from."""
    key, sizes = "spark.sql.adaptive.advisoryPartitionSizeInBytes", []
    keep = tables.stage

    def staged(frame, label):
        made = keep(frame, label)
        if label == "source":
            sizes.append(made[0].groupBy(F.input_file_name()).count().count())
        return made

    monkeypatch.setattr(tables, "stage", staged)
    before = spark.conf.get(key, None)
    spark.conf.set(key, "20k")
    try:
        source = spark.range(0, 100_000, 1, 1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
        tables.upsert_table(source, str(tmp_path / "t"), ["id"], newest_by=["v"])
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
    assert sizes[0] > 1 and tables.read(spark, str(tmp_path / "t")).count() == 100_000
