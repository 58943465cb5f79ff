"""Table access, folds and written intermediate tables shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources import fs

PIECE = 256  # whole rows that a filtering stage unpacks at once
SPACE = b" \t\n\x0b\x0c\r"  # the six characters that separate words everywhere in this subpackage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, k: int) -> Column:
    """crc32 of the key as text, modulo ``k``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % k


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text only, so that further columns, whatever their names, never reach an operator; null texts are empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def free_name(frame: DataFrame, name: str) -> str:
    """The name, lengthened until the frame has no such column."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def label_rows(labels: DataFrame, column: str, folds: int, held_out: int) -> DataFrame:
    """(doc_id, y) of the training folds. Ids labelled both ways, null ids and null labels are left out."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(column).cast("int").alias("y"), F.max(column).cast("int").alias("most"))
        .where("y = most")
        .drop("most")
    )


def bounded_training(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(text, y) of at most ``rows`` labelled ids, chosen by hash. The id list is bounded, so it is broadcast."""
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return texts(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")


_written: list[tuple[SparkSession, str]] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared folder, dropped at exit."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back, so that lost executors re-read files; dropped at exit."""
    spark = frame.sparkSession
    path = shared_path(spark, name)
    frame.write.parquet(path)
    drop_shuffles(spark)
    return spark.read.schema(frame.schema).parquet(path)


def drop_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of a finished job when the driver's heap is collected, on its own after half an hour or when
    the heap is full. Asking for it where a table has been written keeps the disk at what the running job needs."""
    spark.sparkContext._jvm.System.gc()


def written() -> int:
    """Tables written so far, a mark for ``drop_written``."""
    return len(_written)


def drop_written(mark: int = 0, keep: int = 0) -> None:
    """Drops the tables written since a mark, but for the last ``keep`` of them."""
    doomed = _written[mark : len(_written) - keep]
    _written[mark : len(_written) - keep] = []
    for spark, path in doomed:
        if spark.sparkContext._jsc is not None:
            fs.delete(spark, path)


atexit.register(drop_written)


def checkpointed(frame: DataFrame) -> DataFrame:
    """Cuts the lineage in the shared checkpoint folder."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(frame.sparkSession))
    return frame.checkpoint()


def map_batches(
    frame: DataFrame, apply: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, rows: int | None = None
) -> DataFrame:
    """``apply`` over batches, cut into pieces of at most ``rows`` rows where given, so that a worker unpacks and returns little at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, max(batch.num_rows, 1), rows or max(batch.num_rows, 1)):
                out = apply(batch.slice(at, rows) if rows else batch)
                if out is not None:
                    yield out

    return frame.mapInArrow(run, schema)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; nulls are empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def bucketed(frame: DataFrame, key: str, name: str) -> DataFrame:
    """Like ``staged``, but bucketed by ``key``: joins and groups on the key read it where it lies, without a shuffle."""
    spark = frame.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    title = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark).rstrip('/')}/{title}"
    _written.append((spark, path))
    frame.write.format("parquet").option("path", path).option("compression", "zstd").bucketBy(buckets, key).saveAsTable(title)
    drop_shuffles(spark)
    return spark.table(title)


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
