"""Frame-index queries: lookups, upsert, deletes, retention, the commit log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import index as ix
from ..session import scratch_path
from . import mapping as m
from .registry import query

_STATION, _PRODUCT = "K007", "reflectivity"


@query(f"WITH {m.INDEX} SELECT DISTINCT product_name FROM idx WHERE station = '{_STATION}'")
def distinct_products(spark, sf):
    return ix.products_of(m.index(spark, sf), _STATION)


@query(
    f"""WITH {m.INDEX} SELECT timestamp, filename FROM idx WHERE station = '{_STATION}' AND product_name = '{_PRODUCT}'
      ORDER BY timestamp DESC, filename LIMIT 10"""
)
def latest_10(spark, sf):
    return ix.latest(m.index(spark, sf), _STATION, _PRODUCT)


@query(
    f"""WITH {m.INDEX} SELECT station, product_name, timestamp, filename FROM idx
      WHERE timestamp BETWEEN '19970101_000000' AND '19970630_000000' ORDER BY timestamp"""
)
def time_range(spark, sf):
    return ix.in_range(m.index(spark, sf), "19970101_000000", "19970630_000000")


@query(
    f"""WITH {m.INDEX} SELECT timestamp AS t, CAST(CASE WHEN filename = 'volumetric.RDA' THEN 0 ELSE CAST(replace(filename, '.RDA', '') AS DOUBLE) * 10 END AS INTEGER) AS e10,
      CASE WHEN filename = 'volumetric.RDA' THEN 'volume' ELSE 'tilt' END AS kind FROM idx WHERE station = '{_STATION}' AND product_name = '{_PRODUCT}'"""
)
def index_listing(spark, sf):
    rows = ix.listing(m.index(spark, sf), _STATION, _PRODUCT)
    return rows.select("t", F.round(F.col("e") * 10, 0).cast("int").alias("e10"), "kind")


@query(f"WITH {m.INDEX} SELECT station, count(*) AS c, count(DISTINCT product_name) AS products FROM idx GROUP BY 1")
def index_counts(spark, sf):
    return m.index(spark, sf).groupBy("station").agg(F.count("*").alias("c"), F.count_distinct("product_name").alias("products"))


_KEYS = "station, product_name, timestamp, filename"


def _incoming(spark, sf):
    """Index rows of a second load: shifted stations, another code."""
    o = m.index(spark, sf)
    return o.where(F.col("station") < "K050").withColumn("product_code", F.lit(7)).distinct()


@query(
    f"""WITH {m.INDEX}, cur AS (SELECT DISTINCT * FROM idx WHERE station >= 'K030'), inc AS (SELECT DISTINCT {_KEYS}, 7 AS product_code FROM idx WHERE station < 'K050'),
      both_v AS (SELECT {_KEYS}, product_code, 0 AS v FROM cur UNION ALL SELECT {_KEYS}, product_code, 1 FROM inc),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY {_KEYS} ORDER BY v DESC) AS r FROM both_v)
      SELECT {_KEYS}, CAST(product_code AS INTEGER) AS product_code FROM ranked WHERE r = 1"""
)
def index_upsert(spark, sf):
    """Insert or replace on the four key columns."""
    current = m.index(spark, sf).where(F.col("station") >= "K030").distinct()
    return ix.upsert(current, _incoming(spark, sf), ix.KEYS)


@query(f"WITH {m.INDEX} SELECT {_KEYS}, count(*) AS n FROM idx WHERE NOT (station < 'K050' AND filename = 'volumetric.RDA') GROUP BY ALL")
def index_delete(spark, sf):
    """Delete by full key."""
    doomed = m.index(spark, sf).where((F.col("station") < "K050") & (F.col("filename") == "volumetric.RDA")).distinct()
    return ix.delete_rows(m.index(spark, sf), doomed, ix.KEYS).groupBy(*ix.KEYS).agg(F.count("*").alias("n"))


_RANKED = f"""WITH {m.INDEX}, ranked AS (SELECT *, dense_rank() OVER (PARTITION BY station, product_name ORDER BY timestamp DESC) AS r FROM idx)"""


@query(f"{_RANKED} SELECT {_KEYS}, count(*) AS n FROM ranked WHERE r <= 10 GROUP BY ALL")
def retention_topn(spark, sf):
    """Frames of the newest ten timestamps per station and product."""
    return ix.retain(m.index(spark, sf), 10).groupBy(*ix.KEYS).agg(F.count("*").alias("n"))


@query(f"{_RANKED} SELECT {_KEYS}, count(*) AS n FROM ranked WHERE r > 10 GROUP BY ALL")
def retention_expired(spark, sf):
    """What retention removes."""
    return ix.expired(m.index(spark, sf), 10).groupBy(*ix.KEYS).agg(F.count("*").alias("n"))


@query(
    f"""WITH {m.INDEX} SELECT DISTINCT {_KEYS}, 0 AS product_code FROM idx WHERE station >= 'K050' AND product_name <> 'velocity'"""
)
def index_refresh(spark, sf):
    """Index rows for files that are on disk but not indexed."""
    idx = m.index(spark, sf)
    on_disk = idx.distinct().select(
        F.concat_ws("/", F.lit("/base"), "station", "product_name", "timestamp", "filename").alias("key"), F.lit(1).alias("length")
    )
    known = idx.where((F.col("station") < "K050") | (F.col("product_name") == "velocity"))
    return ix.unindexed_files(on_disk, known).select(*ix.COLUMNS)


@query(
    f"""WITH {m.INDEX} SELECT '{{"station":"' || station || '","product_code":' || product_code || ',"product_name":"' || product_name || '","timestamp":"' || timestamp ||
      '","filename":' || CASE WHEN filename = 'volumetric.RDA' THEN 'null' ELSE '"' || filename || '"' END || '}}' AS json, count(*) AS n FROM idx GROUP BY ALL"""
)
def rows_as_json(spark, sf):
    """Query rows as JSON objects, missing values kept as null."""
    idx = m.index(spark, sf).withColumn("filename", F.nullif("filename", F.lit("volumetric.RDA")))
    return ix.json_rows(idx).groupBy("json").agg(F.count("*").alias("n"))


@query(
    f"""WITH {m.INDEX}, cur AS (SELECT DISTINCT * FROM idx WHERE station >= 'K030'), inc AS (SELECT DISTINCT {_KEYS}, 7 AS product_code FROM idx WHERE station < 'K050'),
      merged AS (SELECT {_KEYS}, product_code FROM inc UNION ALL SELECT {_KEYS}, product_code FROM cur WHERE station >= 'K050'),
      ranked AS (SELECT *, dense_rank() OVER (PARTITION BY station, product_name ORDER BY timestamp DESC) AS r FROM merged)
      SELECT {_KEYS}, CAST(product_code AS INTEGER) AS product_code FROM ranked WHERE r <= 10"""
)
def commit_log(spark, sf):
    """The stored index: two commits, a replayed one, a purge, and a compaction, then a read."""
    log = ix.frame_index(spark, scratch_path(spark, "index"))
    log.append(m.index(spark, sf).where(F.col("station") >= "K030").distinct(), 0)
    log.append(_incoming(spark, sf), 1)
    log.append(_incoming(spark, sf), 1)
    log.delete(ix.expired(log.read(), 10).select(*ix.KEYS))
    log.compact()
    return log.read()
