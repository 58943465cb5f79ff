"""The frame index: existence checks, lookups, upsert, delete, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas
from ..functions import timekeys as t
from ..sources import fs

KEYS = ["station", "product_name", "timestamp", "filename"]
COLUMNS = ["station", "product_code", "product_name", "timestamp", "filename"]


def _one_per_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows with equal keys the greatest one. A single further column is kept by a plain maximum, which hashes."""
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    if len(rest) == 1:
        return rows.groupBy(*keys).agg(F.max(rest[0]).alias(rest[0]))
    return rows.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("x")).select(*keys, "x.*")


def upsert(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both, one per key; incoming wins over current. The aggregates leave rows hashed by key, as the join wants."""
    columns = current.columns
    new, old = (_one_per_key(rows.select(*columns), keys) for rows in (incoming, current))
    return old.join(new.select(*keys), keys, "left_anti").select(*columns).unionByName(new.select(*columns))


def delete_rows(current: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    return current.join(doomed.select(*keys), keys, "left_anti")


def has_frames(wanted: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    return wanted.join(index.select(*keys), keys, "left_semi")


def kept_timestamps(index: DataFrame, keep: int, keys: tuple[str, ...] = ("station", "product_name")) -> DataFrame:
    """Newest ``keep`` timestamps per group. Timestamps are made distinct before they are ranked."""
    stamps = index.select(*keys, "timestamp").distinct()
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.col("timestamp").desc()))
    return stamps.withColumn("_r", rank).where(F.col("_r") <= keep).drop("_r")


def retain(index: DataFrame, keep: int, keys: tuple[str, ...] = ("station", "product_name")) -> DataFrame:
    cols = [*keys, "timestamp"]
    return index.join(kept_timestamps(index, keep, keys), cols, "left_semi")


def expired(index: DataFrame, keep: int, keys: tuple[str, ...] = ("station", "product_name")) -> DataFrame:
    cols = [*keys, "timestamp"]
    return index.join(kept_timestamps(index, keep, keys), cols, "left_anti")


def products_of(index: DataFrame, station: str) -> DataFrame:
    return index.where(F.col("station") == station).select("product_name").distinct()


def latest(index: DataFrame, station: str, product: str, n: int = 10) -> DataFrame:
    hit = index.where((F.col("station") == station) & (F.col("product_name") == product))
    return hit.select("timestamp", "filename").orderBy(F.desc("timestamp"), "filename").limit(n)


def in_range(index: DataFrame, start: str, end: str) -> DataFrame:
    hit = index.where(F.col("timestamp").between(start, end))
    return hit.select("station", "product_name", "timestamp", "filename").orderBy("timestamp")


def listing(index: DataFrame, station: str, product: str) -> DataFrame:
    """Index view of one product: timestamp and tilt, newest first; the volume file shows tilt 0."""
    hit = index.where((F.col("station") == station) & (F.col("product_name") == product))
    return hit.select(
        F.col("timestamp").alias("t"),
        t.file_tilt(F.col("filename")).alias("e"),
        F.when(F.col("filename") == t.VOLUME_FILE, F.lit("volume")).otherwise(F.lit("tilt")).alias("kind"),
    ).orderBy(F.desc("t"), "e")


def index_rows(files: DataFrame) -> DataFrame:
    return files.select(
        "station", F.lit(0).alias("product_code"), F.col("product").alias("product_name"), "timestamp", "filename"
    )


def unindexed_files(listing_rows: DataFrame, index: DataFrame) -> DataFrame:
    """Index rows for frame files that exist on disk but not in the index."""
    parts = F.split("key", "/")
    on_disk = listing_rows.where(F.endswith("key", F.lit(".RDA"))).select(
        F.element_at(parts, -4).alias("station"),
        F.lit(0).alias("product_code"),
        F.element_at(parts, -3).alias("product_name"),
        F.element_at(parts, -2).alias("timestamp"),
        F.element_at(parts, -1).alias("filename"),
    )
    return on_disk.join(index.select(*KEYS), KEYS, "left_anti")


def json_rows(rows: DataFrame) -> DataFrame:
    """Each row as one JSON object; missing values stay as null."""
    return rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("json"))


class CommitLog:
    """An upsertable table on plain Parquet: every change appends one commit folder, reads take the newest row per key.

    A commit writes only its own rows, so its cost follows the batch and not the table; replaying a commit number
    overwrites its folder and changes nothing. Deletes are rows marked ``deleted``. ``compact`` folds the log into one
    snapshot, clustered by key. Files are sorted by key, so lookups by station, product and time skip row groups by
    their statistics instead of needing one folder per station.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str]) -> None:
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, keys

    def _numbers(self, kind: str) -> list[int]:
        names = fs.children(self.spark, f"{self.path}/{kind}")
        done = [n for n in names if n.startswith("commit=") and fs.exists(self.spark, f"{self.path}/{kind}/{n}/_SUCCESS")]
        return sorted(int(n.split("=")[1]) for n in done)

    def next_commit(self) -> int:
        return max(self._numbers("log") + self._numbers("snapshot"), default=-1) + 1

    def _write(self, rows: DataFrame, kind: str, commit: int) -> None:
        rows.sortWithinPartitions(*self.keys).write.mode("overwrite").parquet(f"{self.path}/{kind}/commit={commit}")

    def append(self, rows: DataFrame, commit: int | None = None, deleted: bool = False) -> int:
        commit = self.next_commit() if commit is None else commit
        self._write(rows.withColumn("deleted", F.lit(deleted)), "log", commit)
        return commit

    def delete(self, keys: DataFrame, commit: int | None = None) -> int:
        names = set(keys.columns)
        empty = [f for f in self.spark.createDataFrame([], self.schema).schema.fields if f.name not in names]
        return self.append(keys.withColumns({f.name: F.lit(None).cast(f.dataType) for f in empty}), commit, deleted=True)

    def _sources(self, before: int | None = None) -> list[tuple[str, int]]:
        snapshots, log = self._numbers("snapshot"), self._numbers("log")
        if before is not None:
            snapshots, log = [n for n in snapshots if n < before], [n for n in log if n < before]
        base = snapshots[-1:]
        return [("snapshot", n) for n in base] + [("log", n) for n in log if not base or n > base[0]]

    def length(self) -> int:
        """Commits a read has to merge."""
        return len(self._sources())

    def read(self, before: int | None = None) -> DataFrame:
        """Current rows, or those before a commit: a replayed batch must not see what its first attempt left."""
        schema = f"{self.schema}, deleted boolean, commit int"
        sources = self._sources(before)
        columns = [f.name for f in self.spark.createDataFrame([], self.schema).schema.fields]
        if not sources:
            return self.spark.createDataFrame([], self.schema)
        kinds: dict[str, list[str]] = {}
        for kind, n in sources:
            kinds.setdefault(kind, []).append(f"{self.path}/{kind}/commit={n}")
        parts = [
            self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}").parquet(*paths)
            for kind, paths in kinds.items()
        ]
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        rest = [c for c in columns if c not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest, "deleted"), "commit").alias("x"))
        return newest.where(~F.col("x.deleted")).select(*self.keys, *[F.col(f"x.{c}").alias(c) for c in rest]).select(*columns)

    def compact(self) -> int | None:
        """Writes the current rows as a snapshot and drops the folders it replaces."""
        sources = self._sources()
        if not sources:
            return None
        commit = sources[-1][1]
        if sources == [("snapshot", commit)]:
            return commit
        # Ranges over the whole key split a station with very many frames over several files.
        clustered = self.read().withColumn("deleted", F.lit(False)).repartitionByRange(*self.keys)
        self._write(clustered, "snapshot", commit)
        for kind, n in sources:
            fs.delete(self.spark, f"{self.path}/{kind}/commit={n}") if (kind, n) != ("snapshot", commit) else None
        return commit


def frame_index(spark: SparkSession, base: str) -> CommitLog:
    return CommitLog(spark, f"{base.rstrip('/')}/frame_index", schemas.FRAME_INDEX, KEYS)


def file_table(spark: SparkSession, base: str) -> CommitLog:
    keys = ["station", "product", "timestamp", "filename", "tilt"]
    return CommitLog(spark, f"{base.rstrip('/')}/frame_files", schemas.FRAME_FILES, keys)
