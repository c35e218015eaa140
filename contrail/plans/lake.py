"""The layers as jobs on stored tables (BRZ-*, SLV-*, FCT-*, DIM-*, EXP-01).

Each job processes what is new, publishes by partition overwrite and records the
run last.  Repeating a job, whole or after a loss, leaves the same tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from contrail import schemas
from contrail.operators import hashing, quality
from contrail.operators.enrich import Dimension
from contrail.plans import bronze, gold, silver
from contrail.session import discard, pin_utc, stage
from contrail.sources import files, ledger, tables

EXPORTED = (
    "fact_flights", "fact_states", "dim_airports", "dim_airlines_prefixes", "dim_airlines", "dim_dates",
)
# Column with the rows that a deduplicated row stands for, while it is staged.
COUNTED = "_rows"
FLIGHT_FEEDS = {"flights_departure": "dep_date_utc", "flights_arrival": "arr_date_utc"}


@dataclass(frozen=True)
class Lake:
    """Where the tables are."""

    root: str

    def table(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{name}"

    def manifest(self, layer: str) -> str:
        return self.table("meta", f"{layer}_runs")

    def metrics(self, layer: str) -> str:
        return self.table("meta", f"{layer}_metrics")


def _record_run(
    spark: SparkSession,
    lake: Lake,
    layer: str,
    dataset: str,
    sources: Sequence[str],
    run_id: str,
    run_ts: datetime,
    version: str | None,
    status: str = ledger.DONE,
    file_hash: str | None = None,
) -> None:
    rows = spark.createDataFrame([(s, file_hash) for s in sources], "source_file string, file_hash string")
    new = ledger.entries(rows, dataset, run_id, run_ts, status, version)
    ledger.record(new, lake.manifest(layer))


def _write_metrics(lake: Lake, layer: str, metrics: DataFrame) -> None:
    """One row per dataset and run: a repeated run replaces its own."""
    tables.replace_partitions(metrics, lake.metrics(layer), ["dataset", "ingest_id"])


# Bronze.


def ingest_files(
    spark: SparkSession,
    lake: Lake,
    dataset: str,
    raw_root: str,
    ddl: str,
    run_id: str,
    run_ts: datetime,
    name_glob: str = "*.json.gz",
    tagged: bool = False,
    max_files: int | None = None,
) -> int:
    """BRZ-01/02: all unseen files; returns how many.

    ``max_files`` limits a batch, not the call: batches follow one another, the first
    under ``run_id`` and each later one under an id of its own.  A batch is entered as ``processing`` before it is written and as ``done``
    after.  A run that was lost in between is finished first, under its own id
    and time: it overwrites what it may have written, so nothing is twice in the
    table (D3)."""
    pin_utc(spark)
    manifest = ledger.read_manifest(spark, lake.manifest("bronze"))
    lost: dict[tuple, list[str]] = {}
    for row in ledger.unfinished(manifest, dataset).collect():
        lost.setdefault((row["ingest_id"], row["processed_ts"]), []).append(row["source_file"])
    for (lost_id, lost_ts), lost_files in lost.items():
        _load(spark, lake, dataset, lost_files, ddl, lost_id, lost_ts, tagged)

    manifest = ledger.read_manifest(spark, lake.manifest("bronze"))
    found = files.list_files(spark, raw_root, name_glob)
    batches = ledger.batches(ledger.new_files(found, manifest, dataset), max_files)
    for number, batch in enumerate(batches):
        batch_id = f"{run_id}.{number}" if number else run_id
        _record_run(spark, lake, "bronze", dataset, batch, batch_id, run_ts, None, ledger.PROCESSING)
        _load(spark, lake, dataset, batch, ddl, batch_id, run_ts, tagged)
    return sum(map(len, batches))


def _load(spark, lake, dataset, batch, ddl, run_id, run_ts, tagged) -> None:
    raw = files.read_ndjson(spark, batch, ddl)
    write_bronze(lake, dataset, bronze.bronze_frame(raw, run_id, run_ts, tagged), run_id, run_ts)
    _record_run(spark, lake, "bronze", dataset, batch, run_id, run_ts, None)


def write_bronze(lake: Lake, dataset: str, frame: DataFrame, run_id: str, run_ts: datetime) -> None:
    """Parse once: the metrics are taken while the frame is staged; then table and quarantine."""
    spark = frame.sparkSession
    run = quality.ObservedRun(
        frame, dataset, f"batch://{dataset}/{run_id}", run_id, run_ts, exclude=bronze.METADATA
    )
    staged, path = stage(run.frame, dataset)
    try:
        tables.replace_partitions(
            bronze.accepted(staged), lake.table("bronze", dataset), bronze.PARTITION
        )
        malformed = bronze.quarantined(staged)
        if not malformed.isEmpty():
            tables.replace_partitions(malformed, lake.table("quarantine", dataset), bronze.PARTITION)
        _write_metrics(lake, "bronze", run.row())
    finally:
        discard(spark, path)


def ingest_snapshot(
    spark: SparkSession,
    lake: Lake,
    dataset: str,
    file: str,
    ddl: str,
    run_id: str,
    run_ts: datetime,
) -> bool:
    """BRZ-03: a reference file replaces its table when its bytes changed."""
    pin_utc(spark)
    current = files.file_hashes(spark, file).select(F.lit(dataset).alias("dataset"), "source_file", "file_hash")
    seen = current.first()
    manifest = ledger.read_manifest(spark, lake.manifest("bronze"))
    if not ledger.change_gate(current, manifest).first()["needs_processing"]:
        return False
    frame = bronze.bronze_frame(files.read_csv(spark, file, ddl), run_id, run_ts)
    run = quality.ObservedRun(frame, dataset, file, run_id, run_ts, exclude=bronze.METADATA)
    staged, path = stage(run.frame, dataset)
    try:
        tables.overwrite(staged, lake.table("bronze", dataset))
        _write_metrics(lake, "bronze", run.row())
    finally:
        discard(spark, path)
    _record_run(
        spark, lake, "bronze", dataset, [seen["source_file"]], run_id, run_ts, None, ledger.DONE,
        seen["file_hash"],
    )
    return True


# Silver.


def pending_batches(spark: SparkSession, lake: Lake, dataset: str, layer: str = "silver") -> list[str]:
    """Bronze batches the layer has not processed, in order of their time."""
    done = ledger.done_entries(ledger.read_manifest(spark, lake.manifest("bronze")), dataset)
    batches = done.groupBy(F.col("ingest_id").alias("source_file")).agg(F.min("processed_ts").alias("t"))
    manifest = ledger.read_manifest(spark, lake.manifest(layer))
    new = ledger.new_files(batches, manifest, f"{layer}.{dataset}")
    rows = new.orderBy("t", "source_file").collect()
    return [r["source_file"] for r in rows]


def _refresh_silver(
    spark: SparkSession,
    lake: Lake,
    dataset: str,
    build: Callable[[DataFrame], DataFrame],
    key: Sequence[str],
    partition: str,
    run_id: str,
    run_ts: datetime,
    version: str,
    unknown=None,
    extras=None,
) -> int:
    pin_utc(spark)
    pending = pending_batches(spark, lake, dataset)
    if not pending:
        return 0
    # A partition column: only the new batches are read.
    batch = tables.read(spark, lake.table("bronze", dataset)).where(F.col("_ingest_id").isin(pending))
    # Each row says how many it stands for, so the input is counted by the pass that stages it.
    run = quality.ObservedRun(
        build(batch),
        f"silver.{dataset}",
        f"batch://silver.{dataset}/{run_id}",
        run_id,
        run_ts,
        counted=COUNTED,
        exclude=silver.LINEAGE,
        unknown=unknown,
        fresh="_ingest_ts",
        extras=extras,
        notes=f"silver.{dataset} upsert ok",
    )
    staged, path = stage(run.frame, dataset)
    try:
        # Before the upsert: gold looks at these partitions for this run.  Should the run be
        # lost, the next one takes the same batches and enters them again.
        touched = staged.select(F.col(partition).cast("date").alias("day")).distinct()
        touched = touched.select(F.lit(dataset).alias("dataset"), F.lit(run_id).alias("run_id"), "day")
        tables.replace_partitions(touched, lake.table("meta", "silver_days"), ["dataset", "run_id"])
        tables.upsert_table(
            staged,
            lake.table("silver", dataset),
            key,
            [partition],
            newest_by=["_ingest_ts", "_source_file"],
            key_fixes_partition=True,
            staged=True,
        )
        _write_metrics(lake, "silver", run.row())
    finally:
        discard(spark, path)
    _record_run(spark, lake, "silver", f"silver.{dataset}", pending, run_id, run_ts, version)
    return len(pending)


def refresh_states(
    spark: SparkSession, lake: Lake, run_id: str, run_ts: datetime, version: str = "v1.0.0"
) -> int:
    """SLV-01 for the new bronze batches."""

    def build(batch: DataFrame) -> DataFrame:
        return silver.silver_states(batch, run_ts, version, COUNTED)

    outliers = quality.counts_json(
        {
            "velocity_outliers": F.col("flag_velocity_outlier"),
            "alt_outliers": F.col("flag_alt_outlier"),
        }
    )
    return _refresh_silver(
        spark, lake, "states", build, silver.STATES_KEY, "event_date_utc", run_id, run_ts, version,
        extras=outliers,
    )


def refresh_flights(
    spark: SparkSession,
    lake: Lake,
    dataset: str,
    run_id: str,
    run_ts: datetime,
    version: str = "v1.0.0",
) -> int:
    """SLV-02 for the new batches of one feed, against the stored references."""
    airlines = tables.read(spark, lake.table("silver", "ref_airlines_prefixes"))
    airports = tables.read(spark, lake.table("silver", "ref_airports"))

    def build(batch: DataFrame) -> DataFrame:
        return silver.silver_flights(batch, airlines, airports, f"bronze.{dataset}", run_ts, version, COUNTED)

    unknown = {"unknown_dep": F.col("unknown_dep"), "unknown_arr": F.col("unknown_arr")}
    return _refresh_silver(
        spark, lake, dataset, build, silver.FLIGHTS_KEY, FLIGHT_FEEDS[dataset], run_id, run_ts, version,
        unknown=unknown["unknown_dep"] | unknown["unknown_arr"], extras=quality.counts_json(unknown),
    )


_REFERENCES = {
    "ref_airlines_prefixes": (
        silver.silver_ref_airlines, ("prefix", "airline_name"), "airline_name",
    ),
    "ref_airports": (
        silver.silver_ref_airports,
        ("icao", "iata", "name", "city", "region", "type"), "iata",
    ),
}


def refresh_reference(
    spark: SparkSession,
    lake: Lake,
    dataset: str,
    run_id: str,
    run_ts: datetime,
    version: str = "v1.0.0",
) -> str:
    """SLV-03/04: rebuild a reference snapshot; returns its content hash."""
    pin_utc(spark)
    build, hashed, checked = _REFERENCES[dataset]
    source = lake.table("bronze", dataset)
    raw = tables.read(spark, source)
    run = quality.ObservedRun(
        build(raw, run_ts, version, COUNTED),
        f"silver.{dataset}",
        f"snapshot://silver.{dataset}",
        run_id,
        run_ts,
        counted=COUNTED,
        exclude=silver.LINEAGE,
        unknown=F.col(checked).isNull(),
        fresh="_ingest_ts",
        extras=quality.counts_json({f"unknown_{checked}": F.col(checked).isNull()}),
        notes=f"silver.{dataset} snapshot ok",
    )
    staged, path = stage(run.frame, dataset)
    try:
        tables.overwrite(staged, lake.table("silver", dataset))
        _write_metrics(lake, "silver", run.row())
        content = hashing.content_hash(staged, hashed).first()["content_hash"]
    finally:
        discard(spark, path)
    _record_run(
        spark, lake, "silver", f"silver.{dataset}", [source], run_id, run_ts, version, ledger.DONE, content
    )
    return content


# Gold.


def _new_runs(spark: SparkSession, lake: Lake, dataset: str, feeds: Sequence[str]) -> dict[str, list[str]]:
    """Recorded silver runs of each feed that the gold table has not taken, whatever their
    times: a backfill under an early logical time is new like any other."""
    taken = ledger.done_entries(ledger.read_manifest(spark, lake.manifest("gold")), dataset)
    silver_runs = ledger.done_entries(ledger.read_manifest(spark, lake.manifest("silver")))
    runs = silver_runs.select(
        F.substring_index("dataset", ".", -1).alias("feed"),
        F.col("ingest_id").alias("run"),
        F.concat("dataset", F.lit("/"), "ingest_id").alias("source_file"),
    ).where(F.col("feed").isin(list(feeds))).distinct()
    new = runs.join(taken.select("source_file"), "source_file", "left_anti").collect()
    return {feed: sorted(r["run"] for r in new if r["feed"] == feed) for feed in feeds}


def _no_silver(spark: SparkSession, feed: str) -> DataFrame:
    """No rows with the columns of a silver feed: what no raw rows give."""
    lineage = "_ingest_id string, _ingest_ts timestamp, _source_file string, download_ts timestamp, download_date date"
    ddl = schemas.STATES if feed == "states" else schemas.FLIGHTS
    raw, now = spark.createDataFrame([], f"{ddl}, {lineage}"), F.current_timestamp()
    if feed == "states":
        return silver.silver_states(raw, now)
    airlines = spark.createDataFrame([], "prefix string, airline_name string")
    airports = spark.createDataFrame([], "icao string, iata string")
    return silver.silver_flights(raw, Dimension(airlines, True), Dimension(airports, True), f"bronze.{feed}", now)


def _days_of(spark: SparkSession, lake: Lake, feed: str, runs: Sequence[str], partition: str) -> DataFrame:
    """The silver rows of the days that ``runs`` wrote; a partition filter on the table.  A feed
    without a table yet has none."""
    stored = [lake.table("silver", feed), lake.table("meta", "silver_days")]
    if not all(tables.exists(spark, path) for path in stored):
        return _no_silver(spark, feed)
    days = tables.read(spark, lake.table("meta", "silver_days"))
    days = days.where((F.col("dataset") == feed) & F.col("run_id").isin(list(runs)))
    table = tables.read(spark, lake.table("silver", feed))
    return tables.restrict(table, days.select(F.col("day").alias(partition)), [partition])


def _observed_gold(dataset, frame, run_id, run_ts, **measures) -> quality.ObservedRun:
    return quality.ObservedRun(frame, dataset, f"batch://{dataset}/{run_id}", run_id, run_ts, **measures)


def _finish_gold(spark, lake, dataset, run, run_id, run_ts, version, taken=()) -> None:
    _write_metrics(lake, "gold", run.row())
    _record_run(spark, lake, "gold", dataset, [f"run://{run_id}", *taken], run_id, run_ts, version)


def _taken(runs: dict[str, list[str]]) -> list[str]:
    return [f"silver.{feed}/{run}" for feed, own in runs.items() for run in own]


def refresh_fact_flights(
    spark: SparkSession, lake: Lake, run_id: str, run_ts: datetime, version: str = "v1.0.0"
) -> None:
    """FCT-01: the days of silver runs not yet taken, of both feeds, upserted; the freshest
    row wins, so rows of these days that were taken before change nothing."""
    pin_utc(spark)
    dataset = "gold.fact_flights"
    runs = _new_runs(spark, lake, dataset, list(FLIGHT_FEEDS))
    dep, arr = (
        _days_of(spark, lake, feed, runs[feed], partition) for feed, partition in FLIGHT_FEEDS.items()
    )
    facts = gold.fact_flights(dep, arr, run_ts, version, run_id, COUNTED)
    run = _observed_gold(dataset, facts, run_id, run_ts, counted=COUNTED)
    staged, path = stage(run.frame, "fact_flights")
    try:
        tables.upsert_table(
            staged,
            lake.table("gold", "fact_flights"),
            ["flight_id"],
            ["dep_date_utc"],
            newest_by=["_silver_ts", "_ingest_ts", "_source_file"],
            key_fixes_partition=True,
            staged=True,
        )
        _finish_gold(spark, lake, dataset, run, run_id, run_ts, version, _taken(runs))
    finally:
        discard(spark, path)


def refresh_fact_states(
    spark: SparkSession, lake: Lake, run_id: str, run_ts: datetime, version: str = "v1.0.0"
) -> None:
    """FCT-02: recompute the days that silver runs not yet taken wrote, and replace them (D20)."""
    pin_utc(spark)
    dataset = "gold.fact_states"
    runs = _new_runs(spark, lake, dataset, ["states"])
    source = _days_of(spark, lake, "states", runs["states"], "event_date_utc")
    expected = F.lit(gold.EXPECTED_PINGS_PER_DAY)
    # A fact counts its pings, so they need no other pass.
    run = _observed_gold(
        dataset, gold.fact_states(source, run_ts, version, run_id), run_id, run_ts, rows_in=F.sum("pings_count"),
        extras=F.to_json(F.struct(F.coalesce(F.max(expected), expected).alias("expected_pings_per_day"))),
    )
    staged, path = stage(run.frame, "fact_states")
    try:
        tables.replace_partitions(staged, lake.table("gold", "fact_states"), ["event_date_utc"])
        _finish_gold(spark, lake, dataset, run, run_id, run_ts, version, _taken(runs))
    finally:
        discard(spark, path)


def refresh_dimensions(
    spark: SparkSession,
    lake: Lake,
    run_id: str,
    run_ts: datetime,
    as_of: date,
    years_back: int = 3,
    years_fwd: int = 1,
    version: str = "v1.0.0",
) -> None:
    """DIM-01..04.  After the facts: airlines are those the facts contain (D16)."""
    pin_utc(spark)
    upserted = {
        "dim_airports": (gold.dim_airports, "ref_airports", "icao"),
        "dim_airlines_prefixes": (gold.dim_prefixes, "ref_airlines_prefixes", "prefix"),
    }
    for name, (build, reference, key) in upserted.items():
        source = tables.read(spark, lake.table("silver", reference))
        run = _observed_gold(f"gold.{name}", build(source, run_ts, version, run_id), run_id, run_ts)
        staged, path = stage(run.frame, name)
        try:
            tables.upsert_table(staged, lake.table("gold", name), [key], staged=True)
            _finish_gold(spark, lake, f"gold.{name}", run, run_id, run_ts, version)
        finally:
            discard(spark, path)
    facts = tables.read(spark, lake.table("gold", "fact_flights"))
    replaced = {
        "dim_airlines": gold.dim_airlines(facts, run_ts, version, run_id),
        "dim_dates": gold.dim_dates(spark, as_of, run_ts, years_back, years_fwd, version, run_id),
    }
    for name, frame in replaced.items():
        run = _observed_gold(f"gold.{name}", frame, run_id, run_ts)
        staged, path = stage(run.frame, name)
        try:
            tables.overwrite(staged, lake.table("gold", name))
            _finish_gold(spark, lake, f"gold.{name}", run, run_id, run_ts, version)
        finally:
            discard(spark, path)


def export_gold(
    spark: SparkSession,
    lake: Lake,
    out_root: str,
    names: Sequence[str] = EXPORTED,
    single_file: bool = False,
) -> None:
    """EXP-01."""
    for name in names:
        frame = tables.read(spark, lake.table("gold", name))
        tables.export(frame, f"{out_root.rstrip('/')}/{name}", single_file)


def register_all(spark: SparkSession, lake: Lake, layer: str, names: Sequence[str]) -> None:
    """SNK-06."""
    for name in names:
        tables.register(spark, lake.table(layer, name), layer, name)
