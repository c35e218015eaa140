"""What the text and vector operators share: code on the executors, batches, names."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows handed to Python at once.  A batch of whole texts must fit a worker, so it is
#: far below Spark's default of 10 000.
BATCH_ROWS = 128
#: Python takes the texts of a batch apart in parts of about so many bytes.
PART_BYTES = 4 << 20

_SHIPPED: set[str] = set()


def prepare(spark: SparkSession, rows: int = BATCH_ROWS) -> SparkSession:
    """Make the package importable on every executor and keep Arrow batches small."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="contrail-")) / "contrail_code.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        context.addPyFile(str(archive))
        _SHIPPED.add(context.applicationId)
    return spark


def free_name(df: DataFrame, label: str) -> str:
    """A column name that ``df`` does not have."""
    names = {c.lower() for c in df.columns}
    return label if label.lower() not in names else f"{label}_{uuid.uuid4().hex[:8]}"


def whole_text(column: Column | str) -> Column:
    """The text, empty for null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def slots(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts(sizes: Iterable[int], limit: int = PART_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows of about ``limit`` bytes; a longer row stands alone."""
    begin = total = at = 0
    for at, size in enumerate(sizes):
        if total and total + size > limit:
            yield begin, at
            begin, total = at, 0
        total += size
    if total or begin <= at:
        yield begin, at + 1


def text_parts(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Each batch in parts of bounded bytes, with the texts of ``column``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = pa.compute.binary_length(texts).to_pylist()
        for begin, end in parts([s or 0 for s in sizes]):
            yield batch.slice(begin, end - begin), texts.slice(begin, end - begin).to_pylist()
