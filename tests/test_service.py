"""Storage, files, ingest and the service object."""

import json
from pathlib import Path

import pytest
import volume_writer as w
from pyspark.sql import functions as F

from polarscan.operators import discovery
from polarscan.operators import index as ix
from polarscan.plans.config import Config, load_config
from polarscan.plans.decode import decode, frame_files, offline_files
from polarscan.plans.engine import Engine
from polarscan.plans.store import FrameStore
from polarscan.sources import rda, volumes
from polarscan.sources.containers import gzip_best
from polarscan.streaming import ingest, listing, stats

DAY, NOW = "2026/02/13", "2026-02-13"


def volume(seed=1, tilts=(0.5, 1.5)):
    messages = [m for s, e in enumerate(tilts) for m in w.sweep31(e, 6, lambda i: [(i * 7 + g * seed) % 200 for g in range(40)], 0, s + 1, lambda i: [w.vol_block()])]
    return w.ldm(w.volume_header(), [b"".join(messages)])


def drop(root: Path, station: str, time: str, blob: bytes, suffix="_V06"):
    folder = root / DAY / station
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{station}{NOW.replace('-', '')}_{time}{suffix}").write_bytes(blob)


@pytest.fixture(scope="module")
def files(spark):
    rows = [("v", "p", "S", "t", bytearray(volume()))]
    df = spark.createDataFrame(rows, "volume_id string, path string, station string, ts_key string, content binary")
    out = frame_files(decode(df, ["reflectivity"]))
    return out.persist()


def test_store_saves_loads_and_lists(spark, files, tmp_path):
    store = FrameStore(spark, str(tmp_path))
    store.save(files, 0)
    store.save(files, 0)
    tilt = store.load_tilt("KTLX", "reflectivity", "20260212_162244", 0.5).first()
    meta = json.loads(tilt["metadata"])
    assert meta["e"] == 0.5 and meta["r"] == 360 and meta["g"] == 40 and meta["v"] == len(tilt["values"]) and meta["dualpol"]["sys_diff_phase"] == 60.0
    assert list(meta) == sorted(meta)
    vol = json.loads(store.load_volume("KTLX", "reflectivity", "20260212_162244").first()["metadata"])
    assert vol["tilts"] == [0.5, 1.5] and "e" not in vol and vol["r"] == 720
    assert store.has("KTLX", "reflectivity", "20260212_162244") and not store.has("KTLX", "velocity", "20260212_162244")
    assert [(r["t"], r["e"], r["kind"]) for r in store.get_index("KTLX", "reflectivity").collect()] == [
        ("20260212_162244", 0.0, "volume"),
        ("20260212_162244", 0.5, "tilt"),
        ("20260212_162244", 1.5, "tilt"),
    ]
    assert store.list_frames("KTLX", "reflectivity").count() == 3
    assert store.usage()[1] == 3


def test_store_retention_and_compaction(spark, files, tmp_path):
    store = FrameStore(spark, str(tmp_path))
    for i in range(4):
        store.save(files.withColumn("timestamp", F.lit(f"2026021{i}_000000")), i)
    other = files.withColumn("station", F.lit("KCRP")).withColumn("timestamp", F.lit("20250101_000000"))
    store.save(other, 4)
    store.purge(2)
    stamps = {(r["station"], r["timestamp"]) for r in store.index().collect()}
    assert stamps == {("KTLX", "20260212_000000"), ("KTLX", "20260213_000000"), ("KCRP", "20250101_000000")}
    before = sorted(map(tuple, store.files().select("station", "timestamp", "filename").collect()))
    store.compact()
    assert sorted(map(tuple, store.files().select("station", "timestamp", "filename").collect())) == before
    store.compact()
    store.delete(store.index().where("station = 'KCRP'").select(*ix.KEYS))
    assert {r["station"] for r in store.index().collect()} == {"KTLX"} and {r["station"] for r in store.files().collect()} == {"KTLX"}


def test_exported_files_and_index_refresh(spark, files, tmp_path):
    base = str(tmp_path / "out")
    log = rda.export_rda(files, base).collect()
    assert len(log) == 3
    back = rda.load_tilt(spark, base, "KTLX", "reflectivity", "20260212_162244", 1.5).first()
    want = files.where("filename = '1.5.RDA'").first()
    assert (back["metadata"], back["bitmask"], back["values"], back["legacy"]) == (want["metadata"], want["bitmask"], want["values"], False)
    whole = rda.load_volume(spark, base, "KTLX", "reflectivity", "20260212_162244").first()
    assert len(whole["bitmask"]) == 2 * 720 * 40 // 8
    assert rda.parsed_metadata(rda.read_rda(spark, base)).where("meta.r = 720").count() == 1
    listing_rows = volumes.list_objects(spark, base)
    usage = rda.disk_usage(listing_rows).first()
    assert usage["frame_count"] == 3 and usage["bytes"] == sum(r["bytes"] for r in log)
    store = FrameStore(spark, str(tmp_path / "store"))
    store.refresh_index(listing_rows)
    store.refresh_index(listing_rows)
    assert store.index().count() == 3


def test_legacy_and_broken_files(spark, tmp_path):
    folder = tmp_path / "KTLX" / "reflectivity" / "t"
    folder.mkdir(parents=True)
    (folder / "0.5.RDA").write_bytes(gzip_best(json.dumps({"f": "q", "d": "AQIDBAUGBwgJCgsMDQ4="}).encode()))
    (folder / "0.9.RDA").write_bytes(b"not gzip")
    rows = {r["filename"]: r for r in rda.legacy_triplets(rda.read_rda(spark, str(tmp_path))).collect()}
    assert rows["0.5.RDA"]["legacy"] and rows["0.5.RDA"]["n_triplets"] == 2 and rows["0.5.RDA"]["example_value"] == 5
    assert rows["0.9.RDA"]["metadata"] is None


def test_offline_identity(spark):
    rows = [("v", "p", "S", "t", bytearray(volume()))]
    df = spark.createDataFrame(rows, "volume_id string, path string, station string, ts_key string, content binary")
    got = offline_files(df).collect()
    assert {(r["station"], r["timestamp"]) for r in got} == {("TEST", "20260215_000000")} and len(got) == 3
    assert all(json.loads(r["metadata"])["r"] == 720 for r in got)


def test_read_volumes_takes_identity_from_the_key(spark, tmp_path):
    drop(tmp_path, "KTLX", "010101", volume())
    r = volumes.read_volumes(spark, str(tmp_path)).select("station", "ts_key").first()
    assert tuple(r) == ("KTLX", "20260213_010101")
    assert volumes.stations_of(volumes.list_objects(spark, str(tmp_path))).collect()[0][0] == "KTLX"


def test_listing_offsets(tmp_path):
    for time in ("010000", "020000", "030000"):
        drop(tmp_path, "KTLX", time, b"x")
    drop(tmp_path, "KCRP", "010000", b"x")
    src = listing.ListingStream({"path": str(tmp_path), "stations": "ALL", "now": NOW})
    end = src.latestOffset()
    first = src.partitions(src.initialOffset(), end)
    assert sorted(k.rsplit("/", 1)[-1] for p in first for k in p.keys) == ["KCRP20260213_010000_V06", "KTLX20260213_030000_V06"]
    drop(tmp_path, "KTLX", "000500", b"late")
    drop(tmp_path, "KTLX", "040000", b"x")
    after = src.partitions(end, src.latestOffset())
    assert [k.rsplit("/", 1)[-1] for p in after for k in p.keys] == ["KTLX20260213_040000_V06"]
    catchup = listing.ListingStream({"path": str(tmp_path), "stations": "KTLX", "now": NOW, "catchup": "true", "max_frames": "2"})
    assert len(catchup.partitions(catchup.initialOffset(), catchup.latestOffset())[0].keys) == 2


def test_service_ingests_two_drops_and_restarts(spark, tmp_path):
    root, base = tmp_path / "objects", str(tmp_path / "store")
    config = Config(monitored_stations=("ALL",), products=("reflectivity",), catchup_enabled=True, max_frames_per_station=3)
    drop(root, "KTLX", "010000", volume(1))
    drop(root, "KTLX", "020000", b"")
    drop(root, "KTLX", "030000", volume(2), "_V06_MDM")
    drop(root, "KCRP", "010000", volume(3))
    engine = Engine(spark, str(root), base, str(tmp_path / "state"), config)
    engine.run_once(NOW)
    seen = {(r["station"], r["timestamp"]) for r in engine.store.index().collect()}
    assert seen == {("KTLX", "20260213_010000"), ("KCRP", "20260213_010000")}
    drop(root, "KTLX", "040000", volume(4))
    drop(root, "KTLX", "050000", volume(5))
    drop(root, "KTLX", "060000", volume(6))
    again = Engine(spark, str(root), base, str(tmp_path / "state"), config)
    again.run_once(NOW)
    kept = {(r["station"], r["timestamp"]) for r in again.store.index().collect()}
    assert kept == {("KTLX", f"20260213_0{h}0000") for h in (4, 5, 6)} | {("KCRP", "20260213_010000")}
    metrics = again.metrics()
    assert metrics["frames_fetched"] == 10 and metrics["frames_failed"] == 0 and metrics["success_rate"] == 100.0
    assert metrics["station_stats"]["KTLX"]["last_frame_timestamp"] == "20260213_060000"
    assert stats.dashboard(again.station_stats()).count() == 2 and metrics["frame_count"] == 12
    left = [p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir() if p.name.startswith("fetched-")]
    assert left == [], "tables of a finished batch are dropped"
    assert again.status()["fetcher_running"] is False and again.pause()["status"] == "not ingesting"


def test_replayed_batch_changes_nothing(spark, tmp_path):
    root = tmp_path / "objects"
    drop(root, "KTLX", "010000", volume())
    key = f"{DAY}/KTLX/KTLX20260213_010000_V06"
    keys = spark.createDataFrame([("KTLX", key, str(root), "")], "station string, key string, bucket string, timestamp string")
    store = FrameStore(spark, str(tmp_path / "store"))
    config = Config(products=("reflectivity",))
    ingest.ingest_batch(keys, 3, store, config)
    before = sorted(map(tuple, store.index().collect()))
    ingest.ingest_batch(keys, 3, store, config)
    assert len(before) == 3 and sorted(map(tuple, store.index().collect())) == before
    assert store.audit().first()["frames_fetched"] == 2
    ingest.ingest_batch(keys, 4, store, config)
    assert sorted(map(tuple, store.index().collect())) == before and store.audit().count() == 1


def test_failed_fetches_are_recorded(spark, tmp_path):
    drop(tmp_path, "KTLX", "010000", volume())
    key = f"{DAY}/KTLX/KTLX20260213_010000_V06"
    keys = [("KTLX", key, str(tmp_path), "20260213_010000"), ("KTLX", key + "x", str(tmp_path), "20260213_010000")]
    got = volumes.fetch_objects(spark.createDataFrame(keys, "station string, key string, bucket string, timestamp string")).collect()
    assert sorted(r["error"] is None for r in got) == [False, True]


def test_station_and_config_calls(spark, tmp_path):
    engine = Engine(spark, str(tmp_path), str(tmp_path / "s"), str(tmp_path / "state"), Config())
    assert engine.add_station("KABC")["success"] and {"name": "KABC", "status": "active"} in engine.stations()
    assert engine.remove_station("KTLX")["success"] and "error" in engine.add_station("")
    assert engine.set_config('{"max_frames_per_station": 5, "buffer_size_mb": 2}')["config"]["buffer_size_mb"] == 2
    assert "error" in engine.set_config("{")
    reloaded = Engine(spark, str(tmp_path), str(tmp_path / "s"), str(tmp_path / "state"))
    assert reloaded.config.max_frames_per_station == 5 and "KABC" in reloaded.config.monitored_stations


def test_config_priority():
    env = {"POLARSCAN_MONITORED_STATIONS": "KAAA,KBBB", "POLARSCAN_THREADS": "3", "POLARSCAN_BUFFER_SIZE_MB": "1"}
    saved = json.dumps({"monitored_stations": ["KSAV"], "fetcher_thread_pool_size": 2, "scan_interval_seconds": 9})
    c = load_config(saved, env, {"fetcher_thread_pool_size": 7})
    assert c.monitored_stations == ("KAAA", "KBBB") and c.fetcher_thread_pool_size == 7 and c.scan_interval_seconds == 9 and c.buffer_size == 1 << 20
    assert load_config("{broken", {}).monitored_stations == ("KTLX", "KCRP", "KEWX")
    assert load_config(None, {"POLARSCAN_MONITORED_STATIONS": "*"}).monitored_stations == ("ALL",)


def test_discovery_rules(spark):
    keys = [("A", f"k{i}") for i in range(7)] + [("B", "k1"), ("B", "k5")]
    listed = spark.createDataFrame(keys, "station string, key string")
    progress = spark.createDataFrame([("A", "k3")], "station string, last_key string")
    got = sorted(map(tuple, discovery.new_keys(listed, progress).collect()))
    assert got == [("A", "k4"), ("A", "k5"), ("A", "k6"), ("B", "k5")]
    assert discovery.new_keys(listed, progress, 30, catchup=True).count() == 5
