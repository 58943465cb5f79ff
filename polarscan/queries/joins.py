"""Rasterization, band joins and lookups on the mapped tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import products as pr
from ..functions import quantize as q
from ..operators import discovery, index, metadata, moments, raster
from ..operators.radials import angles_in_range
from ..sources import volumes
from . import mapping as m
from .registry import query

_GATE = m.sql_gate("range_m", m.FIRST_GATE, m.GATE_SPACING)
_Q = m.sql_quantize("value", -32, 94.5)


def _cut_rows(spark, sf) -> DataFrame:
    """One tilt per sweep of the mapped bins; odd sweeps have 360 rays."""
    fine = F.col("sweep_id") % 2 == 0
    return m.bins(spark, sf).select("volume_id", "product", "sweep_id").distinct().select(
        "volume_id",
        "product",
        "sweep_id",
        (F.col("sweep_id") - 1).alias("tilt_idx"),
        (F.col("sweep_id") * 0.5).cast("float").alias("tilt"),
        F.when(fine, F.lit(720)).otherwise(F.lit(360)).alias("num_rays"),
        F.lit(m.NUM_GATES).alias("ngates"),
        F.lit(m.FIRST_GATE).cast("float").alias("first_gate"),
        F.lit(m.GATE_SPACING).cast("float").alias("gate_spacing"),
    )


@query(
    f"""WITH {m.BINS}, cell AS (SELECT volume_id, sweep_id - 1 AS tilt_idx, CASE WHEN sweep_id % 2 = 0 THEN 720 ELSE 360 END AS num_rays,
        azimuth, {_GATE} AS gate, {_Q} AS q FROM bin)
      SELECT volume_id, tilt_idx, num_rays, {m.sql_ray('azimuth', 'num_rays')} AS ray, gate, max(q) AS q
      FROM cell WHERE q > 0 AND gate >= 0 AND gate < {m.NUM_GATES} GROUP BY ALL"""
)
def grid_max_2d(spark, sf):
    """Bins to cells of their tilt's grid: gate and ray index, 8-bit code, maximum per cell."""
    cells = raster.cells_2d(m.bins(spark, sf), _cut_rows(spark, sf))
    return cells.select("volume_id", "tilt_idx", "num_rays", "ray", "gate", "q")


@query(
    f"""WITH {m.BINS}, cell AS (SELECT volume_id, sweep_id, {m.sql_ray('azimuth', '720')} AS ray, {_GATE} AS gate, {_Q} AS q FROM bin),
      kept AS (SELECT * FROM cell WHERE q > 0 AND gate >= 0 AND gate < {m.NUM_GATES})
      SELECT volume_id, sweep_id - 1 AS tilt_idx, ray, gate, max(q) AS q FROM (SELECT * FROM kept
        UNION ALL SELECT volume_id, sweep_id, (ray + 1) % 720, gate, q FROM kept WHERE sweep_id % 2 = 1) GROUP BY ALL"""
)
def grid_max_3d_fill(spark, sf):
    """The 720-ray volume; a bin of a 360-ray tilt also fills the next ray."""
    cells = raster.cells_3d(m.bins(spark, sf), _cut_rows(spark, sf))
    return cells.select("volume_id", "tilt_idx", "ray", "gate", "q")


@query(
    f"""WITH {m.BINS}, cell AS (SELECT volume_id, sweep_id - 1 AS tilt_idx, {m.sql_ray('azimuth', '720', 0)} AS ray, {_GATE} AS gate,
        {m.sql_truncate('value')} AS q FROM bin)
      SELECT volume_id, tilt_idx, ray, gate, max(q) AS q FROM cell WHERE q > 0 AND gate >= 0 AND gate < {m.NUM_GATES} GROUP BY ALL"""
)
def grid_offline_3d(spark, sf):
    """The same volume in the offline dialect."""
    cells = raster.cells_3d(m.bins(spark, sf), _cut_rows(spark, sf), raster.OFFLINE)
    return cells.select("volume_id", "tilt_idx", "ray", "gate", "q")


def _sweeps_and_tilts(spark, sf):
    sweeps = m.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("volume_id"),
        F.col("o_orderkey").alias("sweep_id"),
        (F.col("o_totalprice") / F.lit(100000.0)).cast("float").alias("elevation_deg"),
    )
    tilts = m.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("volume_id"),
        (F.col("l_extendedprice") / F.lit(21000.0)).cast("float").alias("tilt"),
        F.col("l_orderkey").alias("tilt_idx"),
    )
    return sweeps, tilts


def _band_sql(tolerance: float) -> str:
    return f"""WITH s AS (SELECT o_custkey AS volume_id, o_orderkey AS sweep_id,
        CAST(o_totalprice / CAST(100000 AS DOUBLE) AS FLOAT) AS e FROM orders),
      t AS (SELECT l_partkey AS volume_id, l_orderkey AS tilt_idx, CAST(l_extendedprice / CAST(21000 AS DOUBLE) AS FLOAT) AS tilt FROM lineitem)
      SELECT volume_id, sweep_id, tilt_idx FROM s JOIN t USING (volume_id) WHERE abs(e - tilt) < {m.sql_f(tolerance)}"""


@query(_band_sql(0.01))
def tilt_band_join(spark, sf):
    """Orders as sweeps, order lines as tilts, matched within 0.01 degrees inside each volume."""
    sweeps, tilts = _sweeps_and_tilts(spark, sf)
    return raster.tilt_band_join(sweeps, tilts, ["volume_id"], raster.INGEST.tolerance).select("volume_id", "sweep_id", "tilt_idx")


@query(_band_sql(0.05))
def tilt_band_join_offline(spark, sf):
    sweeps, tilts = _sweeps_and_tilts(spark, sf)
    return raster.tilt_band_join(sweeps, tilts, ["volume_id"], raster.OFFLINE.tolerance).select("volume_id", "sweep_id", "tilt_idx")


@query(
    """WITH rays AS (SELECT o_custkey AS volume_id, count(*) AS n FROM orders GROUP BY 1)
      SELECT c_custkey AS volume_id, CASE WHEN coalesce(n, 0) * 40 > 400 THEN 720 ELSE 360 END AS num_rays
      FROM customer LEFT JOIN rays ON volume_id = c_custkey"""
)
def ray_count_lookup(spark, sf):
    """Rays per tilt key, looked up from the tilts; unknown keys mean the coarse grid."""
    sweeps = m.table(spark, sf, "orders").select(F.col("o_custkey").alias("volume_id"), F.lit(50).alias("tilt_key"), F.lit(40).alias("ray_count"))
    tilts = m.table(spark, sf, "customer").select(F.col("c_custkey").alias("volume_id"), F.lit(50).alias("tilt_key"))
    rays = metadata.tilt_ray_counts(sweeps)
    return tilts.join(rays, ["volume_id", "tilt_key"], "left").select("volume_id", raster.rays_for(F.col("tilt_rays")).alias("num_rays"))


@query(
    f"""WITH named AS (SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'reflectivity' WHEN 1 THEN 'velocity' WHEN 2 THEN 'spectrum_width'
        WHEN 3 THEN 'differential_reflectivity' WHEN 4 THEN 'differential_phase' WHEN 5 THEN 'correlation_coefficient'
        WHEN 6 THEN 'cross_correlation_ratio' ELSE p_brand END AS product FROM part)
      SELECT p_partkey, product, {m.sql_product('product', 1)} AS code, {m.sql_product('product', 2)} AS block,
        CAST({m.sql_product('product', 3)} * 10 AS INTEGER) AS low10, CAST({m.sql_product('product', 4)} * 10 AS INTEGER) AS high10 FROM named"""
)
def product_lookup(spark, sf):
    """Code, block name and value range by product; unknown products count as reflectivity."""
    names = [*pr.ALL_PRODUCTS, "cross_correlation_ratio"]
    expr = F.col("p_brand")
    for i, name in enumerate(names):
        expr = F.when(F.col("p_partkey") % 8 == i, F.lit(name)).otherwise(expr)
    parts = m.table(spark, sf, "part").select("p_partkey", expr.alias("product"))
    dim = pr.product_dim(spark)
    found = parts.join(F.broadcast(dim), "product", "left")
    p = F.col("product")
    return found.select(
        "p_partkey",
        "product",
        F.coalesce("moment_code", pr.moment_code_of(p)).alias("code"),
        F.coalesce("block_prefix", pr.block_prefix_of(p)).alias("block"),
        F.round(F.coalesce("value_min", pr.value_min_of(p)) * 10, 0).cast("int").alias("low10"),
        F.round(F.coalesce("value_max", pr.value_max_of(p)) * 10, 0).cast("int").alias("high10"),
    )


@query(
    """WITH b AS (SELECT l_orderkey, l_partkey, l_quantity, CASE l_partkey % 8 WHEN 0 THEN 'REF' WHEN 1 THEN 'VEL' WHEN 2 THEN 'SW ' WHEN 3 THEN 'ZDR'
        WHEN 4 THEN 'PHI' WHEN 5 THEN 'RHO' WHEN 6 THEN 'CFP' ELSE 'SWX' END AS name FROM lineitem),
      p AS (SELECT * FROM (VALUES ('velocity', 'VEL'), ('spectrum_width', 'SW'), ('correlation_coefficient', 'RHO'), ('cross_correlation_ratio', 'RHO')) t(product, prefix))
      SELECT name, product, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS qty FROM b JOIN p ON starts_with(name, prefix) GROUP BY ALL"""
)
def block_product_match(spark, sf):
    """Blocks paired with the requested products by name prefix; one block feeds every product of its code."""
    names = ["REF", "VEL", "SW ", "ZDR", "PHI", "RHO", "CFP", "SWX"]
    name = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("l_partkey") % 8 + 1).cast("int"))
    blocks = m.table(spark, sf, "lineitem").select(name.alias("name"), "l_quantity")
    wanted = ["velocity", "spectrum_width", "correlation_coefficient", "cross_correlation_ratio"]
    paired = moments.for_products(blocks, wanted)
    return paired.groupBy("name", "product").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("qty"))


_WANTED = ["reflectivity", "velocity"]


@query(
    f"""WITH {m.INDEX}, full_ts AS (SELECT station, timestamp FROM idx WHERE product_name IN ('reflectivity', 'velocity')
        GROUP BY 1, 2 HAVING count(DISTINCT product_name) = 2)
      SELECT DISTINCT station, timestamp FROM idx i WHERE NOT EXISTS
        (SELECT 1 FROM full_ts f WHERE f.station = i.station AND f.timestamp = i.timestamp)"""
)
def not_fully_indexed(spark, sf):
    """(station, timestamp) pairs that still lack one of the configured products."""
    idx = m.index(spark, sf)
    return discovery.not_fully_indexed(idx.select("station", "timestamp").distinct(), idx, _WANTED)


@query(
    f"""WITH {m.INDEX}, wanted AS (SELECT DISTINCT 'K' || lpad(CAST(user_id % 150 AS VARCHAR), 3, '0') AS station, product_name,
        strftime(CAST(TIMESTAMP '1995-01-01' + to_days(CAST(event_id % 2400 AS INTEGER)) AS TIMESTAMP), '%Y%m%d_%H%M%S') AS timestamp
        FROM events, (VALUES ('reflectivity'), ('velocity')) p(product_name))
      SELECT station, product_name, timestamp FROM wanted w WHERE EXISTS (SELECT 1 FROM idx i
        WHERE i.station = w.station AND i.product_name = w.product_name AND i.timestamp = w.timestamp)"""
)
def has_frame(spark, sf):
    """Requested frames the index already has."""
    day = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("event_id") % 2400).cast("int"))
    wanted = m.table(spark, sf, "events").select(
        F.concat(F.lit("K"), F.lpad((F.col("user_id") % 150).cast("string"), 3, "0")).alias("station"),
        F.explode(F.array(*[F.lit(p) for p in _WANTED])).alias("product_name"),
        F.date_format(day, "yyyyMMdd_HHmmss").alias("timestamp"),
    )
    return index.has_frames(wanted.distinct(), m.index(spark, sf), ["station", "product_name", "timestamp"])


@query(
    """SELECT c_custkey AS volume_id, product, r_name AS site, n_name AS code FROM customer JOIN nation ON n_nationkey = c_nationkey
      JOIN region ON r_regionkey = n_regionkey, (VALUES ('reflectivity'), ('velocity'), ('differential_phase')) p(product)"""
)
def metadata_to_products(spark, sf):
    """Volume metadata repeated on every product frame of the volume."""
    names = ["reflectivity", "velocity", "differential_phase"]
    vols = m.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("volume_id"), F.col("c_nationkey").alias("n_nationkey"), F.explode(F.array(*[F.lit(p) for p in names])).alias("product")
    )
    sites = m.table(spark, sf, "nation").join(m.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return vols.join(sites, "n_nationkey").select("volume_id", "product", F.col("r_name").alias("site"), F.col("n_name").alias("code"))


@query("SELECT DISTINCT user_id AS station FROM events e WHERE NOT EXISTS (SELECT 1 FROM events b WHERE b.user_id = e.user_id AND b.event_type = 'error' AND b.event_id % 5 = 0)")
def idle_stations(spark, sf):
    """Stations without a scan in flight (error events with an id divisible by five stand for running scans)."""
    e = m.table(spark, sf, "events").select(F.col("user_id").alias("station"), "event_type", "event_id")
    busy = e.where((F.col("event_type") == "error") & (F.col("event_id") % 5 == 0)).select("station")
    return e.select("station").distinct().join(busy, "station", "left_anti")


@query(
    f"""WITH {m.OBJECT_KEYS}, disc AS (SELECT DISTINCT regexp_extract(key, '^\\d{{4}}/\\d{{2}}/\\d{{2}}/([^/]+)/', 1) AS station FROM obj)
      SELECT station FROM disc UNION SELECT 'K' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') FROM supplier"""
)
def station_union(spark, sf):
    """Discovered stations and configured ones, without the word that asks for all."""
    configured = m.table(spark, sf, "supplier").select(F.concat(F.lit("K"), F.lpad(F.col("s_nationkey").cast("string"), 3, "0")).alias("station"))
    marker = m.table(spark, sf, "region").select(F.lit("ALL").alias("station"))
    return volumes.expand_stations(configured.union(marker), volumes.stations_of(m.object_keys(spark, sf)))


@query(
    "SELECT CAST(ts AS DATE) AS day, count(*) AS n, min(event_id) AS first_id FROM events WHERE CAST(ts AS DATE) >= (SELECT CAST(max(ts) AS DATE) - 1 FROM events) GROUP BY 1"
)
def two_day_listing(spark, sf):
    """Yesterday's and today's listings put together; the latest event tells what today is."""
    e = m.table(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"))
    today = e.agg(F.max("day").alias("today"))
    # The right side is one row.
    parts = [e.join(F.broadcast(today.select(F.date_sub("today", back).alias("day"))), "day") for back in (1, 0)]
    return parts[0].unionByName(parts[1]).groupBy("day").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query(
    f"""WITH {m.RADIALS} SELECT count(*) AS n, CAST(sum(msg_seq) AS BIGINT) AS ids FROM rad
      WHERE azimuth - {m.sql_f(1)} BETWEEN {m.sql_f(-0.1)} AND {m.sql_f(360.1)} AND elevation * {m.sql_f(40)} BETWEEN {m.sql_f(-5)} AND {m.sql_f(90)}"""
)
def radial_angle_filter(spark, sf):
    """Radials within the accepted azimuths and elevations, after shifting some of them out."""
    az = (F.col("azimuth") - F.lit(1.0).cast("float")).cast("float")
    el = (F.col("elevation") * F.lit(40.0).cast("float")).cast("float")
    return m.radials(spark, sf).where(angles_in_range(az, el)).agg(F.count("*").alias("n"), F.sum("msg_seq").alias("ids"))


@query(
    f"""WITH {m.RADIALS}, t AS (SELECT volume_id, list_sort(list(DISTINCT CAST(msg_seq % 40 AS FLOAT) / {m.sql_f(4)})) AS tilts FROM rad GROUP BY 1)
      SELECT volume_id, i - 1 AS tilt_idx, CAST(tilts[i] * 100 AS INTEGER) AS tilt_key
      FROM (SELECT volume_id, tilts, unnest(range(1, len(tilts) + 1)) AS i FROM t)"""
)
def tilt_index(spark, sf):
    """Position of each tilt among a volume's sorted tilts."""
    rads = m.radials(spark, sf).withColumn("elevation_deg", (F.col("msg_seq") % 40 / F.lit(4.0)).cast("float"))
    listed = metadata.tilts(rads).select("volume_id", F.posexplode("available_tilts").alias("tilt_idx", "tilt"))
    return listed.select("volume_id", F.col("tilt_idx").cast("bigint").alias("tilt_idx"), q.tilt_key(F.col("tilt")).alias("tilt_key"))
