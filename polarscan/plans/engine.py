"""The service as a Python object: stations, configuration, start and stop, metrics."""

from __future__ import annotations

import json
import time
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import __version__
from ..streaming import ingest, stats
from .config import MIB, Config, load_config
from .store import FrameStore

CONFIG_KEYS = (
    "scan_interval_seconds",
    "max_frames_per_station",
    "cleanup_interval_seconds",
    "auto_cleanup_enabled",
    "fetcher_thread_pool_size",
    "buffer_pool_size",
)


class Engine:
    """Runs ingest from ``source`` into ``base``. Changing stations or settings restarts a running stream."""

    def __init__(self, spark: SparkSession, source: str, base: str, state_dir: str, config: Config | None = None) -> None:
        self.spark, self.source, self.state_dir = spark, source, Path(state_dir)
        self.store = FrameStore(spark, base)
        self.started = time.time()
        self.query: StreamingQuery | None = None
        saved = self.state_dir / "config.json"
        self.config = config or load_config(saved.read_text() if saved.exists() else None)

    def _apply(self, config: Config) -> None:
        self.config = config
        self.state_dir.mkdir(parents=True, exist_ok=True)
        (self.state_dir / "config.json").write_text(config.to_json())
        if self.running():
            self.pause()
            self.resume()

    def running(self) -> bool:
        return self.query is not None and self.query.isActive

    def stations(self) -> list[dict]:
        return [{"name": s, "status": "active"} for s in sorted(self.config.monitored_stations)]

    def add_station(self, name: str) -> dict:
        if not name:
            return {"error": "Station name required"}
        self._apply(self.config.with_station(name))
        return {"success": True, "station": name}

    def remove_station(self, name: str) -> dict:
        if not name:
            return {"error": "Station name required"}
        self._apply(self.config.without_station(name))
        return {"success": True, "station": name}

    def set_stations(self, names: list[str]) -> None:
        self._apply(self.config.replace(monitored_stations=tuple(sorted(set(names)))))

    def get_config(self) -> dict:
        shown = {k: getattr(self.config, k) for k in CONFIG_KEYS}
        return {**shown, "buffer_size_mb": self.config.buffer_size // MIB}

    def set_config(self, body: str | dict) -> dict:
        """Changes any subset of the shown settings."""
        try:
            data = json.loads(body) if isinstance(body, str) else dict(body)
            changes = {k: data[k] for k in CONFIG_KEYS if k in data}
            if "buffer_size_mb" in data:
                changes["buffer_size"] = int(data["buffer_size_mb"]) * MIB
            self._apply(self.config.replace(**changes))
            return {"success": True, "config": self.get_config()}
        except (ValueError, TypeError) as error:
            return {"error": str(error)}

    def pause(self) -> dict:
        if not self.running():
            return {"success": True, "status": "not ingesting"}
        self.query.stop()
        self.query.awaitTermination()
        self.query = None
        return {"success": True, "status": "paused", "message": "The ingest stream has ended."}

    def resume(self) -> dict:
        if self.running():
            return {"error": "The ingest stream runs already."}
        self.query = self._start(available_now=False)
        return {"success": True, "status": "resumed"}

    def run_once(self, now: str | None = None) -> None:
        """Processes what is listed now, in bounded batches, then returns."""
        ingest.drained(lambda: self._start(available_now=True, now=now))
        ingest.housekeeping(self.store, self.config)

    def _start(self, available_now: bool, now: str | None = None) -> StreamingQuery:
        checkpoint = f"{self.store.base}/checkpoint"
        return ingest.start_ingest(self.spark, self.source, self.store, self.config, checkpoint, available_now, now)

    def station_stats(self) -> DataFrame:
        return stats.station_stats(self.store.audit())

    def metrics(self) -> dict:
        rows = self.station_stats()
        total = stats.totals(rows).first().asDict()
        used, frames = self.store.usage()
        uptime = int(time.time() - self.started)
        fields = ("frames_fetched", "frames_failed", "last_fetch_ns", "last_frame_timestamp")
        return {
            **total,
            "version": __version__,
            "is_running": self.running(),
            "monitored_stations": sorted(self.config.monitored_stations),
            "uptime_seconds": uptime,
            "avg_frames_per_minute": total["frames_fetched"] / uptime * 60.0 if uptime else 0.0,
            "frame_count": frames,
            "disk_usage_mb": used // MIB,
            "disk_usage_gb": used / 1024**3,
            # At most fifty rows come to the driver.
            "station_stats": {r["station"]: {f: r[f] for f in fields} for r in stats.recent(rows).collect()},
            "last_progress": self.query.lastProgress if self.query is not None else None,
        }

    def status(self) -> dict:
        return {
            "status": "operational",
            "fetcher_running": self.running(),
            "version": __version__,
            "timestamp": int(datetime.now(timezone.utc).timestamp()),
        }
