"""The packed-file export as a data source with commit and abort.

Tasks write under names of their own below ``_staging/JOB`` and leave a manifest each; nothing is seen under its final path
before all tasks have succeeded. The commit then moves the files of the tasks whose messages it was given, so that an attempt
that was repeated or overtaken never shows, and a failed export leaves nothing. A message holds a task's number of files and
bytes and the place of its manifest, not the names of its files.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

STAGING = "_staging"
MOVERS = 32
LOG = pa.schema([("path", pa.string()), ("bytes", pa.int64())])


def file_system(where: str) -> tuple[pafs.FileSystem, str]:
    """The file system and inner path of a location; ``s3a`` is the same store as ``s3``."""
    if where.startswith("s3a://"):
        where = "s3://" + where[len("s3a://") :]
    remote = "://" in where or where.startswith("file:")
    return pafs.FileSystem.from_uri(where) if remote else (pafs.LocalFileSystem(), where)


@dataclass
class Staged(WriterCommitMessage):
    folder: str
    manifest: str
    files: int
    bytes: int


class RdaWriter(DataSourceArrowWriter):
    """Rows are (name, content): a path below the base and the bytes of the file."""

    def __init__(self, options: dict) -> None:
        self.base = options["path"].rstrip("/")
        self.log = options["log"].rstrip("/")
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        system, base = file_system(self.base)
        task = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        folder, names, sizes = f"{STAGING}/{self.job}/{task}", [], []
        system.create_dir(f"{base}/{folder}", recursive=True)
        for batch in iterator:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content")):
                content = content.as_py()
                with system.open_output_stream(f"{base}/{folder}/{len(names)}") as out:  # by number: no second tree of folders
                    out.write(content)
                names.append(name)
                sizes.append(len(content))
        log, root = file_system(self.log)
        log.create_dir(root, recursive=True)
        manifest = f"{self.job}-{task}.parquet"
        paths = [f"{self.base}/{name}" for name in names]
        with log.open_output_stream(f"{root}/.{manifest}") as out:  # hidden until the commit
            pq.write_table(pa.table([pa.array(paths, pa.string()), pa.array(sizes, pa.int64())], schema=LOG), out)
        return Staged(folder, manifest, len(names), sum(sizes))

    def commit(self, messages: list[Staged | None]) -> None:
        system, base = file_system(self.base)
        log, root = file_system(self.log)
        done = [m for m in messages if m is not None]

        def moved(number: int, name: str, folder: str) -> None:
            target = f"{base}/{name}"
            system.create_dir(target.rsplit("/", 1)[0], recursive=True)
            system.move(f"{base}/{folder}/{number}", target)

        with ThreadPoolExecutor(MOVERS) as pool:
            for message in done:
                with log.open_input_file(f"{root}/.{message.manifest}") as source:
                    names = [p[len(self.base) + 1 :] for p in pq.read_table(source).column("path").to_pylist()]
                list(pool.map(lambda at, m=message: moved(*at, m.folder), enumerate(names)))
        for message in done:
            log.move(f"{root}/.{message.manifest}", f"{root}/{message.manifest}")
        self._drop_staging()

    def abort(self, messages: list[Staged | None]) -> None:
        self._drop_staging()
        log, root = file_system(self.log)
        found = log.get_file_info(pafs.FileSelector(root, allow_not_found=True))
        for info in found:
            if info.base_name.startswith(f".{self.job}-"):
                log.delete_file(info.path)

    def _drop_staging(self) -> None:
        system, base = file_system(self.base)
        job = f"{base}/{STAGING}/{self.job}"
        if system.get_file_info(job).type == pafs.FileType.Directory:
            system.delete_dir(job)
        staging = f"{base}/{STAGING}"
        if system.get_file_info(staging).type == pafs.FileType.Directory and not system.get_file_info(pafs.FileSelector(staging)):
            system.delete_dir(staging)


class RdaSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rda_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> RdaWriter:
        return RdaWriter(self.options)


def write(spark: SparkSession, rows: DataFrame, base: str, log: str) -> DataFrame:
    """Writes (name, content) rows below ``base``; returns what was committed as (path, bytes)."""
    spark.dataSource.register(RdaSink)
    rows.select("name", "content").write.format("rda_files").mode("append").option("log", log).save(base)
    return spark.read.schema("path string, bytes bigint").parquet(log)
