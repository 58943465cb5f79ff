"""Sweeps, metadata, packing and quality checks on the mapped tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import quantize as q
from ..functions import timekeys as t
from ..operators import discovery, metadata, pack, quality, radials
from ..operators.points import NO_DATA_AT_OR_BELOW
from ..sources import rda
from . import mapping as m
from .registry import query

_ELEV = "CAST((msg_seq // 300) % 5 AS INTEGER)"
_SEG = f"""{m.RADIALS}, lagged AS (SELECT *, {_ELEV} AS en, lag({_ELEV}) OVER w AS prev FROM rad WINDOW w AS (PARTITION BY volume_id ORDER BY msg_seq)),
      seg AS (SELECT *, CAST(sum(CASE WHEN radial_status IN (0, 3, 5) OR prev IS NULL OR en <> prev THEN 1 ELSE 0 END)
        OVER (PARTITION BY volume_id ORDER BY msg_seq ROWS UNBOUNDED PRECEDING) AS INTEGER) - 1 AS sweep_id FROM lagged)"""

def _segmented(spark, sf):
    rads = m.radials(spark, sf).withColumn("elev_num", (F.floor(F.col("msg_seq") / 300) % 5).cast("int"))
    return radials.sweep_segments(rads)


@query(f"WITH {_SEG} SELECT volume_id, msg_seq, sweep_id FROM seg")
def sweep_sessions(spark, sf):
    """Sweep number of every radial: new at a start status, a changed elevation number, or the first radial."""
    return _segmented(spark, sf).select("volume_id", "msg_seq", "sweep_id")


@query(
    f"""WITH {m.RADIALS}, typed AS (SELECT *, CASE WHEN msg_seq % 5 = 0 THEN 1 ELSE 31 END AS msg_type, CAST((msg_seq // 300) % 5 AS INTEGER) AS en,
        row_number() OVER (PARTITION BY volume_id ORDER BY msg_seq) AS rn FROM rad),
      marked AS (SELECT *, CASE WHEN msg_type = 31 THEN en WHEN radial_status IN (0, 3, 5) OR rn = 1 THEN 255 END AS after FROM typed),
      cur AS (SELECT *, last_value(after IGNORE NULLS) OVER (PARTITION BY volume_id ORDER BY msg_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS now FROM marked)
      SELECT volume_id, msg_seq, CAST(sum(CASE WHEN radial_status IN (0, 3, 5) OR rn = 1 OR (msg_type = 31 AND en <> now) THEN 1 ELSE 0 END)
        OVER (PARTITION BY volume_id ORDER BY msg_seq ROWS UNBOUNDED PRECEDING) AS INTEGER) - 1 AS sweep_id FROM cur"""
)
def sweep_sessions_mixed(spark, sf):
    """The same on a stream where every fifth radial is a legacy one without elevation number."""
    rads = m.radials(spark, sf).withColumns(
        {
            "elev_num": (F.floor(F.col("msg_seq") / 300) % 5).cast("int"),
            "msg_type": F.when(F.col("msg_seq") % 5 == 0, F.lit(1)).otherwise(F.lit(31)),
        }
    )
    return radials.sweep_segments(rads).select("volume_id", "msg_seq", "sweep_id")


@query(
    f"""WITH {_SEG} SELECT volume_id, sweep_id, min(msg_seq) AS start_seq, max(msg_seq) AS end_seq, CAST(arg_min(elevation, msg_seq) * 10 AS INTEGER) AS elev10,
      arg_min(en, msg_seq) AS elev_num, CAST(count(*) AS INTEGER) AS ray_count FROM seg GROUP BY ALL"""
)
def sweep_table(spark, sf):
    """One row per sweep: extent, elevation of its first radial, rays."""
    rows = metadata.sweeps(_segmented(spark, sf))
    return rows.select("volume_id", "sweep_id", "start_seq", "end_seq", F.round(F.col("elevation_deg") * 10, 0).cast("int").alias("elev10"), "elev_num", "ray_count")


@query(
    f"""WITH {_SEG}, sw AS (SELECT volume_id, sweep_id, arg_min(elevation, msg_seq) AS e, count(*) AS n FROM seg GROUP BY ALL)
      SELECT volume_id, CAST({m.sql_round(f'CAST(e * {m.sql_f(100)} AS FLOAT)')} AS INTEGER) AS tilt_key, CAST(sum(n) AS INTEGER) AS tilt_rays FROM sw GROUP BY ALL"""
)
def rays_per_tilt(spark, sf):
    """Rays per tilt key, over all sweeps that share the key."""
    return metadata.tilt_ray_counts(metadata.sweeps(_segmented(spark, sf)))


@query(
    f"""WITH {_SEG} SELECT volume_id, count(DISTINCT sweep_id) AS nsweeps, count(*) AS nrays, CAST(min(elevation) * 10 AS INTEGER) AS min_elev10,
      CAST(max(k) * 100 AS INTEGER) AS max_range FROM seg GROUP BY 1"""
)
def volume_counts(spark, sf):
    """Sweeps, rays, lowest elevation and largest range per volume."""
    seg = _segmented(spark, sf)
    return seg.groupBy("volume_id").agg(
        F.count_distinct("sweep_id").alias("nsweeps"),
        F.count("*").alias("nrays"),
        F.round(F.coalesce(F.min("elevation"), F.lit(metadata.EMPTY_ELEVATION)) * 10, 0).cast("int").alias("min_elev10"),
        (F.max("k") * 100).cast("int").alias("max_range"),
    )


@query(
    """WITH g AS (SELECT user_id AS volume_id, event_type AS product, arg_min(k, event_id) AS ngates, arg_min(event_id, event_id) AS first_gate, arg_min(v, event_id) AS gate_spacing
      FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(floor(value) AS INTEGER) AS v FROM events) WHERE k > 10 GROUP BY ALL)
      SELECT * FROM g"""
)
def first_geometry(spark, sf):
    """Gate geometry of the first moment with more than ten gates."""
    rows = m.radials(spark, sf).select(
        "volume_id",
        F.col("event_type").alias("product"),
        "msg_seq",
        F.lit(0).alias("block_no"),
        F.col("k").alias("num_gates"),
        F.col("msg_seq").alias("first_gate"),
        F.floor("value").cast("int").alias("gate_spacing"),
    )
    return metadata.first_geometry(rows, ["volume_id", "product"])


@query(
    f"""WITH {m.RADIALS} SELECT volume_id, elev_num, max_by(k, msg_seq) FILTER (k > 60) AS nyquist, max_by(msg_seq, msg_seq) FILTER (k > 60) AS at_seq
      FROM rad GROUP BY ALL HAVING count(*) FILTER (k > 60) > 0"""
)
def last_metadata(spark, sf):
    """The last value given wins; zero (here: up to 60) is "not given"."""
    given = F.col("k") > 60
    rads = m.radials(spark, sf).groupBy("volume_id", "elev_num")
    last = rads.agg(
        metadata.last_by(F.col("k"), F.col("msg_seq"), given).alias("nyquist"),
        metadata.last_by(F.col("msg_seq"), F.col("msg_seq"), given).alias("at_seq"),
    )
    return last.where(F.col("nyquist").isNotNull())


@query(f"WITH {m.RADIALS} SELECT volume_id, arg_min(product, msg_seq) AS product, CAST(arg_min(elevation, msg_seq) * 10 AS INTEGER) AS elev10 FROM rad GROUP BY 1")
def first_radial(spark, sf):
    """What the first radial of a volume says."""
    always = F.lit(True)
    return m.radials(spark, sf).groupBy("volume_id").agg(
        metadata.first_by(F.col("product"), F.col("msg_seq"), always).alias("product"),
        F.round(metadata.first_by(F.col("elevation"), F.col("msg_seq"), always) * 10, 0).cast("int").alias("elev10"),
    )


@query(
    f"""WITH {m.RADIALS} SELECT volume_id, array_to_string(list_transform(list_sort(list(DISTINCT elevation)), lambda x: printf('%.1f', x)), ',') AS tilts FROM rad GROUP BY 1"""
)
def distinct_tilts(spark, sf):
    """Sorted distinct elevations per volume."""
    rads = m.radials(spark, sf).withColumnRenamed("elevation", "elevation_deg")
    as_text = F.array_join(F.transform("available_tilts", lambda x: F.format_string("%.1f", x)), ",")
    return metadata.tilts(rads).select("volume_id", as_text.alias("tilts"))


_BIT = f"((CAST({m.sql_ray('azimuth', '720')} AS BIGINT)) * 100 + k)"


def _set_bits(spark, sf):
    bit = q.cell_index(q.ray_index(F.col("azimuth"), 720), F.col("k"), 100)
    return m.radials(spark, sf).select(F.col("elev_num").alias("frame"), bit.alias("bit_idx")).distinct()


@query(
    f"""WITH {m.RADIALS}, bits AS (SELECT DISTINCT elev_num AS frame, {_BIT} AS bit_idx FROM rad)
      SELECT frame, bit_idx // 8 AS byte_idx, CAST(sum(1 << CAST(7 - bit_idx % 8 AS INTEGER)) AS INTEGER) AS byte FROM bits GROUP BY ALL"""
)
def bitmask_pack(spark, sf):
    """Presence bitmask bytes, most significant bit first."""
    return pack.mask_bytes(_set_bits(spark, sf), ["frame"])


@query(
    f"""WITH {m.RADIALS}, bits AS (SELECT DISTINCT elev_num AS frame, {_BIT} AS bit_idx FROM rad)
      SELECT frame, bit_idx, row_number() OVER (PARTITION BY frame ORDER BY bit_idx) - 1 AS rank FROM bits"""
)
def bitmask_rank(spark, sf):
    """Where each set bit's value sits in the packed values."""
    return pack.value_ranks(_set_bits(spark, sf), ["frame"])


@query(
    """SELECT l_orderkey, string_agg(lower(hex(encode(l_returnflag || l_linestatus))), '' ORDER BY l_linenumber, l_returnflag || l_linestatus) AS bytes_hex,
      count(*) AS pieces FROM lineitem GROUP BY 1"""
)
def bytes_concat(spark, sf):
    """Pieces put together in order, as bytes. Equal pieces are counted first, so an order with very many lines still
    brings only a few dozen rows together."""
    keys = ["l_orderkey", "l_linenumber"]
    piece = F.concat("l_returnflag", "l_linestatus").alias("p")
    runs = m.table(spark, sf, "lineitem").groupBy(*keys, piece).agg(F.count("*").alias("n"))
    in_order = F.array_sort(F.collect_list(F.struct("l_linenumber", "p", "n")))
    joined = F.array_join(F.transform(in_order, lambda x: F.repeat(F.lower(F.hex(x["p"].cast("binary"))), x["n"].cast("int"))), "")
    return runs.groupBy("l_orderkey").agg(joined.alias("bytes_hex"), F.sum("n").alias("pieces"))


@query(
    """WITH numbered AS (SELECT user_id, event_id, CAST((event_id * 3 + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END) % 65536 AS INTEGER) AS sequence_num FROM events),
      lagged AS (SELECT *, lag(sequence_num) OVER (PARTITION BY event_id // 1000 ORDER BY event_id) AS previous FROM numbered)
      SELECT event_id, sequence_num, previous FROM lagged WHERE previous IS NOT NULL AND sequence_num <> (previous + 1) % 65536"""
)
def sequence_gaps(spark, sf):
    """Sequence numbers that do not follow their predecessor."""
    number = (F.col("event_id") * 3 + F.when(F.col("event_id") % 50 == 0, F.lit(1)).otherwise(F.lit(0))) % 65536
    e = m.table(spark, sf, "events").select(
        F.floor(F.col("event_id") / 1000).alias("volume_id"), "event_id", number.cast("int").alias("sequence_num")
    )
    return quality.sequence_gaps(e, ["volume_id"], "event_id").select("event_id", "sequence_num", "previous")


@query(
    f"""WITH {m.RADIALS}, az AS (SELECT DISTINCT volume_id, CAST(floor(CAST(azimuth * {m.sql_f(1000)} AS DOUBLE) + 0.5) AS INTEGER) AS a FROM rad),
      gaps AS (SELECT volume_id, a, a - lag(a) OVER (PARTITION BY volume_id ORDER BY a) AS step FROM az)
      SELECT volume_id, count(*) AS unique_azimuths, CAST(greatest(coalesce(max(step), 0), 360000 - max(a) + min(a)) AS INTEGER) AS max_gap_milli,
        greatest(coalesce(max(step), 0), 360000 - max(a) + min(a)) > 1100 AS flagged FROM gaps GROUP BY 1"""
)
def azimuth_gaps(spark, sf):
    """Widest gap around the circle per volume."""
    return quality.azimuth_gaps(m.radials(spark, sf), ["volume_id"])


@query(
    f"""WITH {m.BINS} SELECT volume_id, product, count(*) AS total_bins,
      count(DISTINCT CAST(floor(CAST(azimuth * {m.sql_f(1000)} AS DOUBLE) + 0.5) AS INTEGER)) AS unique_azimuths FROM bin GROUP BY ALL"""
)
def bin_counts(spark, sf):
    return quality.bin_counts(m.bins(spark, sf))


@query(
    """SELECT user_id AS volume_id, event_type AS product, event_id AS msg_seq, CAST(json_extract_string(props, '$.k') AS INTEGER) AS gate FROM events
      WHERE user_id % 3 = 0 ORDER BY volume_id, product, msg_seq, gate LIMIT 20"""
)
def sample_bins(spark, sf):
    """The first twenty bins of the first sweeps."""
    rads = m.radials(spark, sf).select(
        "volume_id", F.col("event_type").alias("product"), "msg_seq", F.col("k").alias("gate"), (F.col("volume_id") % 3).alias("sweep_id")
    )
    return quality.sample_bins(rads).drop("sweep_id")


@query(
    """SELECT source AS station, lang AS product, CAST(sum(n_chars) AS BIGINT) AS bytes, count_if(doc_id % 3 <> 0) AS frame_count FROM documents GROUP BY ALL"""
)
def usage_by_product(spark, sf):
    """Stored bytes and frame files per station and product folder."""
    suffix = F.when(F.col("doc_id") % 3 == 0, F.lit(".tmp")).otherwise(F.lit(".RDA"))
    listing = m.table(spark, sf, "documents").select(
        F.concat(F.lit("/base/"), "source", F.lit("/"), "lang", F.lit("/t/"), F.col("doc_id").cast("string"), suffix).alias("key"),
        F.col("n_chars").alias("length"),
    )
    return rda.disk_usage(listing, ["station", "product"])


@query(
    """SELECT user_id AS station, count_if(event_type <> 'error') AS frames_fetched, count_if(event_type = 'error') AS frames_failed,
      max(event_id) AS last_fetch, max_by(strftime(ts, '%Y%m%d_%H%M%S'), event_id) AS last_frame FROM events GROUP BY 1"""
)
def station_stats(spark, sf):
    """Fetched, failed and last activity per station."""
    failed = F.col("event_type") == "error"
    e = m.table(spark, sf, "events")
    return e.groupBy(F.col("user_id").alias("station")).agg(
        F.count_if(~failed).alias("frames_fetched"),
        F.count_if(failed).alias("frames_failed"),
        F.max("event_id").alias("last_fetch"),
        F.max_by(F.date_format("ts", "yyyyMMdd_HHmmss"), "event_id").alias("last_frame"),
    )


@query(
    """SELECT user_id AS station, count(*) AS n, max(event_id) AS last_fetch FROM events GROUP BY 1 ORDER BY last_fetch DESC, station LIMIT 50"""
)
def top50_stations(spark, sf):
    """The fifty stations with the latest activity."""
    stats = m.table(spark, sf, "events").groupBy(F.col("user_id").alias("station")).agg(
        F.count("*").alias("n"), F.max("event_id").alias("last_fetch")
    )
    return stats.orderBy(F.desc("last_fetch"), "station").limit(50)


@query("SELECT 'K' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS station, count(*) AS frames FROM events GROUP BY 1 ORDER BY 1 LIMIT 5")
def dashboard_stations(spark, sf):
    """Station lines of a 24-row terminal, alphabetical."""
    station = F.concat(F.lit("K"), F.lpad(F.col("user_id").cast("string"), 5, "0"))
    stats = m.table(spark, sf, "events").groupBy(station.alias("station")).agg(F.count("*").alias("frames"))
    return stats.orderBy("station").limit(24 - 19)


@query(
    f"""WITH {m.OBJECT_KEYS}, prog AS (SELECT station, min(key) AS last_key FROM obj WHERE event_id % 2 = 0 AND station < 'K100' GROUP BY 1),
      ranked AS (SELECT o.*, last_key, row_number() OVER (PARTITION BY o.station ORDER BY key DESC) AS r FROM obj o LEFT JOIN prog p ON p.station = o.station)
      SELECT station, key FROM ranked WHERE (last_key IS NOT NULL AND key > last_key) OR (last_key IS NULL AND r <= 30)"""
)
def first_contact_catchup(spark, sf):
    """Keys behind the last processed one; at first contact the latest thirty."""
    keys = m.object_keys(spark, sf)
    known = keys.where((F.col("event_id") % 2 == 0) & (F.col("station") < "K100"))
    progress = known.groupBy("station").agg(F.min("key").alias("last_key"))
    return discovery.new_keys(keys.select("station", "key"), progress, 30, catchup=True)


@query(f"WITH {m.OBJECT_KEYS} SELECT station, max(key) AS key FROM obj GROUP BY 1")
def first_contact_latest(spark, sf):
    """At first contact without catch-up only the latest key."""
    keys = m.object_keys(spark, sf).select("station", "key")
    nothing = keys.where(F.lit(False)).select("station", F.col("key").alias("last_key"))
    return discovery.new_keys(keys, nothing)


@query("SELECT user_id, event_id, CAST((row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1) // 5 AS BIGINT) AS batch FROM events")
def batches_of_five(spark, sf):
    """Each station's objects in batches of five, in time order."""
    e = m.table(spark, sf, "events").select("user_id", "event_id", "ts")
    return discovery.batches(e, ["user_id"], "ts").select("user_id", "event_id", "batch")


@query("SELECT event_id, key FROM (SELECT event_id, strftime(ts, '%Y/%m/%d') || '/' || user_id AS key FROM events) ORDER BY key, event_id")
def sorted_keys(spark, sf):
    """All keys in ascending order (a range-partitioned sort)."""
    key = F.concat(F.date_format("ts", "yyyy/MM/dd"), F.lit("/"), F.col("user_id").cast("string"))
    return m.table(spark, sf, "events").select("event_id", key.alias("key")).orderBy("key", "event_id")


@query(
    """SELECT k, CAST(floor(value * 1000 + 0.5) AS BIGINT) AS milli, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_type END AS kind, count(*) AS n,
      'N/A' AS label FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events) WHERE value > 100 GROUP BY ALL"""
)
def point_filter(spark, sf):
    """Values above the no-data limit (here: shifted by 200), with their counts."""
    rads = m.radials(spark, sf).where(F.col("value") - 200 > NO_DATA_AT_OR_BELOW)
    kind = F.when(F.col("msg_seq") % 4 != 0, F.col("event_type"))
    milli = F.floor(F.col("value") * 1000 + F.lit(0.5))
    return rads.groupBy("k", milli.alias("milli"), kind.alias("kind")).agg(F.count("*").alias("n")).withColumn("label", t.clock_from_ns(F.lit(0)))
