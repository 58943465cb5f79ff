"""Exports leave all files or none, and their log is what was committed."""

import pytest
from polarscan.sources import rda_sink
from pyspark.sql import functions as F


def names(root):
    return sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.is_file() and not p.name.endswith(".crc"))


def rows(spark, n):
    return spark.range(n).repartition(4).select(F.format_string("K%03d/reflectivity/%d.RDA", F.col("id") % 3, "id").alias("name"), F.encode(F.repeat(F.lit("x"), F.col("id").cast("int")), "utf-8").alias("content"))


def test_committed_files_and_log(spark, tmp_path):
    log = rda_sink.write(spark, rows(spark, 40), str(tmp_path / "out"), str(tmp_path / "log"))
    wanted = sorted((f"{tmp_path}/out/K{i % 3:03d}/reflectivity/{i}.RDA", i) for i in range(40))
    assert sorted(map(tuple, log.collect())) == wanted
    assert names(tmp_path / "out") == sorted(p[len(f"{tmp_path}/out/") :] for p, _ in wanted)
    assert (tmp_path / "out/K001/reflectivity/7.RDA").read_bytes() == b"xxxxxxx"
    # a second export adds and replaces
    rda_sink.write(spark, rows(spark, 41), str(tmp_path / "out"), str(tmp_path / "log2"))
    assert len(names(tmp_path / "out")) == 41


def test_failed_export_leaves_nothing(spark, tmp_path):
    rda_sink.write(spark, rows(spark, 2), str(tmp_path / "out"), str(tmp_path / "log"))
    before = names(tmp_path)
    bad = rows(spark, 60).withColumn("content", F.when(F.col("name").endswith("/59.RDA"), F.raise_error(F.lit("broken"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="broken"):
        rda_sink.write(spark, bad, str(tmp_path / "out"), str(tmp_path / "log"))
    assert names(tmp_path) == before and not (tmp_path / "out" / rda_sink.STAGING).exists()


def test_only_the_committed_attempt_shows(tmp_path, monkeypatch):
    import pyarrow as pa

    class Task:
        partitionId = staticmethod(lambda: 0)

    monkeypatch.setattr(rda_sink.TaskContext, "get", staticmethod(lambda: Task))
    writer = rda_sink.RdaWriter({"path": str(tmp_path / "out"), "log": str(tmp_path / "log")})
    batch = lambda text: pa.RecordBatch.from_pydict({"name": ["a/b.RDA"], "content": [text]})
    writer.write(iter([batch(b"first attempt")]))  # its message is lost
    second = writer.write(iter([batch(b"second")]))
    assert not (tmp_path / "out/a/b.RDA").exists() and (second.files, second.bytes) == (1, 6)
    writer.commit([second, None])
    assert (tmp_path / "out/a/b.RDA").read_bytes() == b"second" and names(tmp_path / "out") == ["a/b.RDA"]


def test_empty_export(spark, tmp_path):
    assert rda_sink.write(spark, rows(spark, 0), str(tmp_path / "out"), str(tmp_path / "log")).count() == 0
