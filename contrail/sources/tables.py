"""Partitioned Parquet tables: append, overwrite, upsert, register (SNK-*).

A table keeps its schema beside its files, in a folder that Spark's listings skip.  Every
read is under it: no column depends on which footer is looked at, and partition values
keep their declared type.  A write that brings new columns adds them to the schema first;
files written before then read as NULL there.

A table whose keys move between partitions keeps a digest too: the hashes of the keys of each
partition.  It may name too many partitions for a key, never too few; a write that does not
keep it up removes it."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from contrail.operators import merge as merging
from contrail.session import discard, path_exists, remove_folder, stage

SCHEMA_FOLDER, DIGEST_FOLDER = "_schema", "_keys"
KEY_HASH = "_key_hash"

# How partition values are written as folder names.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
ESCAPED = {chr(c) for c in range(1, 32)} | set("\"#%'*/:=?\\{[]^\x7f")


def exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)


def schema_of(spark: SparkSession, path: str) -> T.StructType:
    """The declared schema; of a folder that was not written here, that of all its footers."""
    folder = f"{path.rstrip('/')}/{SCHEMA_FOLDER}"
    if exists(spark, folder):
        return T.StructType.fromJson(json.loads(spark.read.text(folder).first()["value"]))
    return spark.read.option("mergeSchema", "true").parquet(path).schema


def read(spark: SparkSession, path: str) -> DataFrame:
    """SRC-05: the table under its declared schema."""
    return spark.read.schema(schema_of(spark, path)).parquet(path)


def _declare(spark: SparkSession, path: str, schema: T.StructType) -> None:
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    text = spark.createDataFrame([(nullable.json(),)], "value string").coalesce(1)
    text.write.mode("overwrite").option("partitionOverwriteMode", "static").text(
        f"{path.rstrip('/')}/{SCHEMA_FOLDER}"
    )


def _evolve(df: DataFrame, path: str) -> None:
    """Declare the columns of ``df`` that the table does not have; refuse another type."""
    spark = df.sparkSession
    if not exists(spark, path):
        _declare(spark, path, df.schema)
        return
    known = schema_of(spark, path)
    types = {f.name: f.dataType for f in known.fields}
    for field in df.schema.fields:
        kept = types.get(field.name)
        if kept is not None and kept.simpleString() != field.dataType.simpleString():
            raise ValueError(
                f"{field.name} is {kept.simpleString()} in {path}, not {field.dataType.simpleString()}"
            )
    added = [f for f in df.schema.fields if f.name not in types]
    if added or not exists(spark, f"{path.rstrip('/')}/{SCHEMA_FOLDER}"):
        _declare(spark, path, T.StructType([*known.fields, *added]))


def ensure(spark: SparkSession, path: str, ddl: str) -> None:
    """SRC-10: an empty unpartitioned table if there is none."""
    if not exists(spark, path):
        overwrite(spark.createDataFrame([], ddl), path)


def _writer(df: DataFrame, partition_cols: Sequence[str]):
    if not partition_cols:
        return df.write
    # Rebalancing by partition value keeps the number of files low; unlike a
    # plain repartition it splits a value that holds much of the data.
    return df.hint("rebalance", *partition_cols).write.partitionBy(*partition_cols)


def append(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    """SNK-01."""
    _forget_keys(df.sparkSession, path)
    _evolve(df, path)
    _writer(df, partition_cols).mode("append").parquet(path)


def overwrite(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    """SNK-02: replace the whole table, schema included.  ``df`` must not read it."""
    _forget_keys(df.sparkSession, path)
    writer = _writer(df, partition_cols).mode("overwrite")
    writer.option("partitionOverwriteMode", "static").parquet(path)
    _declare(df.sparkSession, path, df.schema)


def replace_partitions(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """SNK-03: replace the partitions that occur in ``df`` and no others.

    Repeating the write gives the same table, so a lost run is simply run again."""
    _forget_keys(df.sparkSession, path)
    _replace(df, path, partition_cols)


def _replace(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    _evolve(df, path)
    writer = _writer(df, partition_cols).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


# The digest of keys.


def _digest_path(path: str) -> str:
    return f"{path.rstrip('/')}/{DIGEST_FOLDER}"


def _forget_keys(spark: SparkSession, path: str) -> None:
    """Before a write that does not keep the digest up: a stale one would miss keys."""
    if exists(spark, _digest_path(path)):
        remove_folder(spark, _digest_path(path))


def _hashed(df: DataFrame, keys: Sequence[str], partition_cols: Sequence[str], schema: T.StructType) -> DataFrame:
    """Partition and hash of every key, as the table's types."""
    typed = [F.col(k).cast(schema[k].dataType) for k in keys]
    return df.select(*[F.col(c).cast(schema[c].dataType) for c in partition_cols], F.xxhash64(*typed).alias(KEY_HASH))


def _write_keys(hashes: DataFrame, path: str, partition_cols: Sequence[str], mode: str, overwrite: str = "dynamic") -> None:
    """Sorted, so that the files are small and say which hashes they can hold."""
    ordered = hashes.hint("rebalance", *partition_cols).sortWithinPartitions(*partition_cols, KEY_HASH)
    writer = ordered.write.partitionBy(*partition_cols).mode(mode)
    writer.option("partitionOverwriteMode", overwrite).parquet(_digest_path(path))


def _build_keys(spark: SparkSession, path: str, keys: Sequence[str], partition_cols: Sequence[str]) -> None:
    """The digest of the whole table, by one scan of its keys; complete once it says so."""
    _forget_keys(spark, path)
    table = read(spark, path)
    _write_keys(_hashed(table, keys, partition_cols, table.schema), path, partition_cols, "overwrite", "static")
    of = spark.createDataFrame([(json.dumps([list(keys), list(partition_cols)]),)], "value string").coalesce(1)
    of.write.text(f"{_digest_path(path)}/_of")


def _has_keys(spark: SparkSession, path: str, keys: Sequence[str], partition_cols: Sequence[str]) -> bool:
    of = f"{_digest_path(path)}/_of"
    return exists(spark, f"{of}/_SUCCESS") and json.loads(spark.read.text(of).first()["value"]) == [
        list(keys), list(partition_cols),
    ]


def candidate_partitions(source: DataFrame, path: str, keys: Sequence[str], partition_cols: Sequence[str]) -> DataFrame:
    """The partitions that can hold a key of ``source`` now, by the digest alone: eight bytes a
    key are read, and no file of the table.  Without a digest it is built first."""
    spark = source.sparkSession
    if not _has_keys(spark, path, keys, partition_cols):
        _build_keys(spark, path, keys, partition_cols)
    table = schema_of(spark, path)
    schema = T.StructType([*[table[c] for c in partition_cols], T.StructField(KEY_HASH, T.LongType())])
    digest = spark.read.schema(schema).parquet(_digest_path(path))
    wanted = _hashed(source, keys, (), table).distinct()
    return digest.join(wanted, KEY_HASH, "left_semi").select(*partition_cols).distinct()


def upsert_table(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_cols: Sequence[str] = (),
    set_when_matched: Mapping[str, Column] | None = None,
    when: Column | None = None,
    newest_by: Sequence[str] = (),
    key_fixes_partition: bool = False,
    staged: bool = False,
) -> list[Row]:
    """SNK-04/05: keyed upsert into the table at ``path``.

    Only partitions that can change are read and rewritten: those of the source
    and, unless ``key_fixes_partition`` says that a key never moves, those where
    its keys are now, as the digest of keys names them.  The result is staged in the shared folder and published
    by one partition overwrite, so nothing reads the path it writes and a lost
    executor costs a task, not the table.  Errors surface; the table is created
    only when it is missing (D4).  Columns that either side lacks are NULL there; a
    source without a column keeps the stored values.  NULL keys are refused.  ``staged`` says that the source is a stored
    frame already.  Returns the values of the partitions that were rewritten."""
    spark = source.sparkSession
    scratch = []
    if not staged:
        # Many files: one large file without row groups would be one task of every pass over it.
        source, source_path = stage(source.hint("rebalance", *keys), "source")
        scratch.append(source_path)
    try:
        return _upsert_stored(
            source, path, keys, partition_cols, set_when_matched, when, newest_by,
            key_fixes_partition, scratch,
        )
    finally:
        for staged_path in scratch:
            discard(spark, staged_path)


def _upsert_stored(
    source, path, keys, partition_cols, set_when_matched, when, newest_by, key_fixes_partition, scratch
) -> list[Row]:
    spark = source.sparkSession
    merging.require_keys(source, keys)
    if not newest_by:
        merging.require_unique(source, keys)
    if not exists(spark, path):
        first = merging.newest(source, keys, newest_by) if newest_by else source
        _publish(first, path, partition_cols)
        return first.select(*partition_cols).distinct().collect() if partition_cols else []

    target = read(spark, path)
    moving = bool(partition_cols) and not key_fixes_partition
    old_partitions, rewritten = None, []
    if partition_cols:
        touched = source.select(*partition_cols)
        if moving:
            old_partitions, old_path = stage(candidate_partitions(source, path, keys, partition_cols), "candidates")
            scratch.append(old_path)
            touched = touched.union(old_partitions)
        # One value per touched partition, whose folders the driver lists anyway.
        rewritten = touched.distinct().collect()
        target = among(target, rewritten, partition_cols)

    merged, merged_path = stage(
        _merged(target, source, keys, set_when_matched, when, newest_by), "merged"
    )
    scratch.append(merged_path)
    if not moving:
        _publish(merged, path, partition_cols)
        return rewritten
    # Old partitions that the merged rows do not reach are emptied by keys that moved
    # away.  Found, and their folders named, before anything is published.
    emptied = _emptied(old_partitions, merged, partition_cols)
    # The digest first learns where the keys will be and last forgets where they were: a run
    # lost in between leaves one that names a partition too many.
    hashes = _hashed(merged, keys, partition_cols, merged.schema)
    _write_keys(_hashed(source, keys, partition_cols, merged.schema), path, partition_cols, "append")
    _replace(merged, path, partition_cols)
    for folder in emptied:
        empty = merged.drop(*partition_cols).limit(0)
        empty.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{folder}")
    _write_keys(hashes, path, partition_cols, "overwrite")
    for folder in emptied:
        hashes.select(KEY_HASH).limit(0).write.mode("overwrite").parquet(f"{_digest_path(path)}/{folder}")
    return rewritten


def _merged(target, source, keys, set_when_matched, when, newest_by) -> DataFrame:
    if newest_by:
        return merging.upsert_newest(target, source, keys, newest_by)
    if set_when_matched is not None or when is not None:
        updates = set_when_matched or {c: F.col(f"s.{c}") for c in source.columns}
        return merging.merge(target, source, keys, updates, when)
    return merging.upsert(target, source, keys)


def _publish(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    if partition_cols:
        replace_partitions(df, path, partition_cols)
    else:
        overwrite(df, path)


def restrict(df: DataFrame, partitions: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Rows of the given partitions; the literal list prunes directories, of which the
    driver lists every one anyway."""
    return among(df, partitions.distinct().collect(), partition_cols)


def among(df: DataFrame, values: Sequence[Row], partition_cols: Sequence[str]) -> DataFrame:
    """Rows of the partitions with these values."""
    if len(partition_cols) == 1:
        present = [v[0] for v in values if v[0] is not None]
        condition = F.col(partition_cols[0]).isin(present)
        if len(present) < len(values):
            condition = condition | F.col(partition_cols[0]).isNull()
        return df.where(condition)
    condition = F.lit(False)
    for value in values:
        match = F.lit(True)
        for column, part in zip(partition_cols, value):
            match = match & F.col(column).eqNullSafe(F.lit(part))
        condition = condition | match
    return df.where(condition)


def _emptied(old: DataFrame, merged: DataFrame, partition_cols: Sequence[str]) -> list[str]:
    """Folders that held a key of the source and hold no merged row; one per partition."""
    kept = merged.select(*[F.col(c).alias(f"_kept_{c}") for c in partition_cols]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_kept_{c}")) for c in partition_cols]
    gone = old.distinct().join(kept, same, "left_anti")
    names = gone.select(*[F.col(c).cast("string") for c in partition_cols]).collect()
    return ["/".join(folder_name(c, row[c]) for c in partition_cols) for row in names]


def folder_name(column: str, value: str | None) -> str:
    """The folder of a partition value given as text; an empty text is written like NULL."""
    def escaped(text: str) -> str:
        return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in text)

    return f"{escaped(column)}={escaped(value) if value else NULL_PARTITION}"


def register(spark: SparkSession, path: str, database: str, table: str) -> None:
    """SNK-06: a catalog entry for an existing table folder.  Run again after a
    job that added partitions, it makes them known."""
    name = f"`{database}`.`{table}`"
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{location}'")
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)


def export(df: DataFrame, path: str, single_file: bool = False) -> None:
    """SNK-07: Parquet snapshot for BI tools.  One file means one writing task, so
    it is a choice for small tables only."""
    snapshot = df.coalesce(1) if single_file else df
    snapshot.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
