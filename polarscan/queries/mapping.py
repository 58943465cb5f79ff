"""The given tables seen as radar data, and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..products import PRODUCTS

# Fixed values of the mapping: event type, elevation angle, elevation number, product.
EVENT_TILTS = [
    ("view", 0.5, 1, "reflectivity"),
    ("signup", 0.9, 2, "velocity"),
    ("purchase", 1.3, 3, "spectrum_width"),
    ("error", 1.8, 4, "differential_reflectivity"),
    ("click", 2.4, 5, "correlation_coefficient"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_type(index: int) -> Column:
    expr = None
    for row in EVENT_TILTS:
        hit, value = F.col("event_type") == row[0], F.lit(row[index])
        expr = F.when(hit, value) if expr is None else expr.when(hit, value)
    return expr


def sql_by_type(index: int) -> str:
    whens = " ".join(f"WHEN '{row[0]}' THEN {row[index]!r}" for row in EVENT_TILTS)
    return f"CASE event_type {whens} END"


def radials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as radials: the user is the volume, the event id is the stream order."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").alias("volume_id"),
        F.col("event_id").alias("msg_seq"),
        "ts",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        by_type(1).cast("float").alias("elevation"),
        by_type(2).alias("elev_num"),
        by_type(3).alias("product"),
        (F.pmod(F.col("event_id") * 37, F.lit(3600)) / F.lit(10.0)).cast("float").alias("azimuth"),
        (F.col("value") * F.lit(1000.0)).cast("float").alias("range_m"),
        F.when(F.col("event_id") % 97 == 0, F.lit(0)).when(F.col("event_id") % 89 == 0, F.lit(3)).otherwise(F.lit(1)).alias("radial_status"),
    )


RADIALS = f"""rad AS (
  SELECT user_id AS volume_id, event_id AS msg_seq, ts, event_type, value,
    CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    CAST({sql_by_type(1)} AS FLOAT) AS elevation, {sql_by_type(2)} AS elev_num, {sql_by_type(3)} AS product,
    CAST(CAST((event_id * 37) % 3600 AS DOUBLE) / CAST(10 AS DOUBLE) AS FLOAT) AS azimuth,
    CAST(value * CAST(1000 AS DOUBLE) AS FLOAT) AS range_m,
    CASE WHEN event_id % 97 = 0 THEN 0 WHEN event_id % 89 = 0 THEN 3 ELSE 1 END AS radial_status
  FROM events)"""


def bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as bins: the supplier is the volume, the line number the sweep."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("volume_id"),
        F.lit("reflectivity").alias("product"),
        F.col("l_linenumber").alias("sweep_id"),
        (F.pmod(F.col("l_partkey") * 7 + F.col("l_orderkey") * 3, F.lit(3600)) / F.lit(10.0)).cast("float").alias("azimuth"),
        F.col("l_extendedprice").cast("float").alias("range_m"),
        (F.col("l_quantity") * F.lit(2.5) - F.lit(35.0)).cast("float").alias("value"),
    )


BINS = """bin AS (
  SELECT l_suppkey AS volume_id, 'reflectivity' AS product, l_linenumber AS sweep_id,
    CAST(CAST((l_partkey * 7 + l_orderkey * 3) % 3600 AS DOUBLE) / CAST(10 AS DOUBLE) AS FLOAT) AS azimuth,
    CAST(l_extendedprice AS FLOAT) AS range_m,
    CAST(l_quantity * CAST(2.5 AS DOUBLE) - CAST(35 AS DOUBLE) AS FLOAT) AS value
  FROM lineitem)"""

# Grid of the mapped bins.
FIRST_GATE, GATE_SPACING, NUM_GATES = 2125.0, 250.0, 400


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the frame index: the customer's bucket is the station, the status and day give product and time."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("K"), F.lpad((F.col("o_custkey") % 150).cast("string"), 3, "0")).alias("station"),
        F.lit(0).alias("product_code"),
        F.when(F.col("o_orderstatus") == "F", F.lit("reflectivity"))
        .when(F.col("o_orderstatus") == "O", F.lit("velocity"))
        .otherwise(F.lit("spectrum_width"))
        .alias("product_name"),
        F.date_format("o_orderdate", "yyyyMMdd_HHmmss").alias("timestamp"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("volumetric.RDA"))
        .otherwise(F.format_string("%.1f.RDA", (F.col("o_orderkey") % 20).cast("double") / F.lit(2.0)))
        .alias("filename"),
    )


INDEX = """idx AS (
  SELECT 'K' || lpad(CAST(o_custkey % 150 AS VARCHAR), 3, '0') AS station, 0 AS product_code,
    CASE o_orderstatus WHEN 'F' THEN 'reflectivity' WHEN 'O' THEN 'velocity' ELSE 'spectrum_width' END AS product_name,
    strftime(o_orderdate, '%Y%m%d_%H%M%S') AS timestamp,
    CASE WHEN o_orderkey % 7 = 0 THEN 'volumetric.RDA'
      ELSE printf('%.1f.RDA', CAST(o_orderkey % 20 AS DOUBLE) / 2) END AS filename
  FROM orders)"""


def object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as listed objects; every 13th is a metadata object and every 17th has a short name."""
    e = table(spark, sf_dir, "events")
    station = F.concat(F.lit("K"), F.lpad((F.col("user_id") % 1000).cast("string"), 3, "0"))
    stamp = F.date_format("ts", "yyyyMMdd_HHmmss")
    suffix = F.when(F.col("event_id") % 13 == 0, F.lit("_V06_MDM")).otherwise(F.lit("_V06"))
    name = F.when(F.col("event_id") % 17 == 0, F.substring(stamp, 1, 12)).otherwise(F.concat(station, stamp, suffix))
    return e.select(
        "event_id", station.alias("station"), F.concat_ws("/", F.date_format("ts", "yyyy/MM/dd"), station, name).alias("key")
    )


OBJECT_KEYS = """obj AS (
  SELECT event_id, st AS station, strftime(ts, '%Y/%m/%d') || '/' || st || '/' ||
    CASE WHEN event_id % 17 = 0 THEN substr(stamp, 1, 12)
      ELSE st || stamp || CASE WHEN event_id % 13 = 0 THEN '_V06_MDM' ELSE '_V06' END END AS key
  FROM (SELECT *, 'K' || lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') AS st,
    strftime(ts, '%Y%m%d_%H%M%S') AS stamp FROM events))"""


def sql_f(x) -> str:
    return f"CAST({x} AS FLOAT)"


def sql_round(x: str) -> str:
    """Nearest whole number of a float32 expression, halves away from zero."""
    d = f"CAST({x} AS DOUBLE)"
    return f"(sign({d}) * floor(abs({d}) + 0.5))"


def sql_unit(v: str, low, high) -> str:
    return f"least(greatest(({sql_f(v)} - {sql_f(low)}) / ({sql_f(high)} - {sql_f(low)}), {sql_f(0)}), {sql_f(1)})"


def sql_quantize(v: str, low, high) -> str:
    return f"CAST(floor(CAST({sql_unit(v, low, high)} * {sql_f(255)} AS DOUBLE) + 0.5) AS INTEGER)"


def sql_truncate(v: str) -> str:
    scaled = f"({sql_f(v)} - {sql_f(-32)}) / ({sql_f(95)} - {sql_f(-32)}) * {sql_f(255)}"
    code = f"CAST(floor(least(greatest({scaled}, {sql_f(0)}), {sql_f(255)})) AS INTEGER)"
    return f"CASE WHEN {sql_f(v)} <= {sql_f(-32)} THEN 0 ELSE {code} END"


def sql_ray(az: str, n: str, eps=0.01) -> str:
    raw = f"CAST(floor({sql_f(az)} * ({sql_f(n)} / {sql_f(360)}) + {sql_f(eps)}) AS INTEGER)"
    return f"((({raw} % {n}) + {n}) % {n})"


def sql_gate(rng: str, first, spacing) -> str:
    return f"CAST(floor(({sql_f(rng)} - {sql_f(first)}) / {sql_f(spacing)}) AS INTEGER)"


def sql_product(col: str, index: int) -> str:
    default = PRODUCTS[0][index]
    whens = " ".join(f"WHEN '{p[0]}' THEN {p[index]!r}" for p in PRODUCTS)
    return f"(CASE {col} {whens} WHEN 'cross_correlation_ratio' THEN {PRODUCTS[-1][index]!r} ELSE {default!r} END)"
