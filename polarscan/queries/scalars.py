"""Scalar expressions and byte-level functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import products as pr
from ..functions import bytes_be as b
from ..functions import f32 as f
from ..functions import geometry as g
from ..functions import quantize as q
from ..functions import timekeys as t
from . import mapping as m
from .registry import query

_LOW, _HIGH = m.sql_product("product", 3), m.sql_product("product", 4)


@query(
    f"WITH {m.RADIALS} SELECT msg_seq, product, {m.sql_quantize('value - 100', _LOW, _HIGH)} AS q FROM rad"
)
def quantize_u8(spark, sf):
    p = F.col("product")
    code = q.quantize(F.col("value") - 100, pr.value_min_of(p), pr.value_max_of(p))
    return m.radials(spark, sf).select("msg_seq", "product", code.alias("q"))


@query(
    f"""WITH {m.RADIALS} SELECT msg_seq, product, CAST(floor((CAST({_LOW} AS FLOAT)::DOUBLE + (msg_seq % 256)::DOUBLE / 255::DOUBLE
      * (CAST({_HIGH} AS FLOAT)::DOUBLE - CAST({_LOW} AS FLOAT)::DOUBLE)) * 1000 + 0.5) AS BIGINT) AS milli FROM rad"""
)
def dequantize_u8(spark, sf):
    p = F.col("product")
    value = q.dequantize(F.col("msg_seq") % 256, pr.value_min_of(p), pr.value_max_of(p))
    return m.radials(spark, sf).select("msg_seq", "product", F.floor(value * 1000 + F.lit(0.5)).alias("milli"))


@query(
    f"""WITH {m.RADIALS} SELECT msg_seq,
      CAST(floor(CAST({m.sql_unit('azimuth', 0, 360)} * {m.sql_f(65535)} AS DOUBLE) + 0.5) AS INTEGER) AS az16 FROM rad"""
)
def quantize_azimuth_u16(spark, sf):
    return m.radials(spark, sf).select("msg_seq", q.quantize_azimuth(F.col("azimuth")).alias("az16"))


@query(f"WITH {m.BINS} SELECT value, {m.sql_truncate('value')} AS q, count(*) AS n FROM bin GROUP BY ALL")
def quantize_offline(spark, sf):
    value = F.col("value")
    code = F.when(value <= f.f32(-32.0), F.lit(0)).otherwise(q.quantize_truncating(value, -32.0, 95.0))
    return m.bins(spark, sf).select("value", code.alias("q")).groupBy("value", "q").agg(F.count("*").alias("n"))


_RAW = "CAST(l_partkey % 256 AS FLOAT)"
_CAL = f"(({_RAW} - {m.sql_f('l_quantity')}) / {m.sql_f('l_linenumber')})"
_CAL1 = f"(({_RAW} - {m.sql_f(66)}) * {m.sql_f(0.5)})"


def _tenth(x: str) -> str:
    return f"CAST({m.sql_round(f'CAST({x} * {m.sql_f(10)} AS FLOAT)')} AS BIGINT)"


@query(
    f"""SELECT raw, scale, "offset", tenths, legacy_tenths, count(*) AS n FROM (
      SELECT CAST(l_partkey % 256 AS INTEGER) AS raw, l_linenumber AS scale, CAST(l_quantity AS INTEGER) AS "offset",
        {_tenth(_CAL)} AS tenths, {_tenth(_CAL1)} AS legacy_tenths FROM lineitem
      WHERE l_partkey % 256 > 1 AND {_CAL} >= {m.sql_f(-32)}) GROUP BY ALL"""
)
def calibrate_round(spark, sf):
    """Calibration, below-threshold and low-reflectivity filters, rounding to tenths."""
    raw = F.col("l_partkey") % 256
    li = m.table(spark, sf, "lineitem").select(
        raw.cast("int").alias("raw"),
        F.col("l_linenumber").alias("scale"),
        F.col("l_quantity").cast("int").alias("offset"),
        q.calibrate(raw, F.col("l_quantity"), F.col("l_linenumber")).alias("v"),
        q.calibrate_legacy(raw).alias("v1"),
    )
    tenths = [F.round(q.round_tenth(F.col(c)) * 10, 0).cast("bigint").alias(n) for c, n in (("v", "tenths"), ("v1", "legacy_tenths"))]
    kept = li.where((F.col("raw") > 1) & (F.col("v") >= f.f32(q.MIN_DBZ))).select("raw", "scale", "offset", *tenths)
    return kept.groupBy(*kept.columns).agg(F.count("*").alias("n"))


@query(
    f"""WITH {m.RADIALS} SELECT msg_seq, CAST({m.sql_round(f'CAST({m.sql_f("value")} * {m.sql_f(100)} AS FLOAT)')} AS INTEGER) AS tilt_key,
      CAST({m.sql_round(f'CAST({m.sql_f("value")} * {m.sql_f(10)} AS FLOAT)')} AS INTEGER) AS tenths FROM rad"""
)
def tilt_keys(spark, sf):
    value = F.col("value").cast("float")
    group = q.elevation_group(value)
    return m.radials(spark, sf).select(
        "msg_seq", q.tilt_key(value).alias("tilt_key"), F.round(group * 10, 0).cast("int").alias("tenths")
    )


@query(
    f"""WITH {m.BINS} SELECT azimuth, gate, ray_360, ray_720, CAST(ray_720 AS BIGINT) * {m.NUM_GATES} + gate AS cell,
      (CAST(sweep_id AS BIGINT) * 720 + ray_720) * {m.NUM_GATES} + gate AS cell_3d, count(*) AS n
      FROM (SELECT azimuth, sweep_id, {m.sql_gate('range_m', m.FIRST_GATE, m.GATE_SPACING)} AS gate,
        {m.sql_ray('azimuth', '360')} AS ray_360, {m.sql_ray('azimuth', '720')} AS ray_720 FROM bin) GROUP BY ALL"""
)
def polar_cell_index(spark, sf):
    az = F.col("azimuth")
    placed = m.bins(spark, sf).select(
        "azimuth",
        "sweep_id",
        q.gate_index(F.col("range_m"), m.FIRST_GATE, m.GATE_SPACING).alias("gate"),
        q.ray_index(az, 360).alias("ray_360"),
        q.ray_index(az, 720).alias("ray_720"),
    )
    ray, gate = F.col("ray_720"), F.col("gate")
    cells = placed.select(
        "azimuth",
        "gate",
        "ray_360",
        "ray_720",
        q.cell_index(ray, gate, m.NUM_GATES).alias("cell"),
        q.cell_index(ray, gate, m.NUM_GATES, F.col("sweep_id")).alias("cell_3d"),
    )
    return cells.groupBy(*cells.columns).agg(F.count("*").alias("n"))


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') || '_' ||
      strftime(TIMESTAMP '1970-01-01' + to_milliseconds((o_orderkey * 7919) % 86400000), '%H%M%S') AS ts_key,
      datediff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) + 1 AS julian FROM orders"""
)
def julian_and_key(spark, sf):
    ms = (F.col("o_orderkey") * 7919) % 86400000
    days = t.day_number(F.to_date("o_orderdate"))
    return m.table(spark, sf, "orders").select(
        "o_orderkey", t.julian_to_key(days, ms).alias("ts_key"), days.cast("bigint").alias("julian")
    )


@query(
    f"""WITH {m.OBJECT_KEYS}, named AS (SELECT *, regexp_extract(key, '[^/]*$') AS fname FROM obj)
      SELECT event_id, station, substr(fname, 5, 8) || '_' || substr(fname, strpos(fname, '_') + 1, 6) AS timestamp
      FROM named WHERE NOT contains(fname, '_MDM') AND length(fname) >= 20"""
)
def object_key_timestamps(spark, sf):
    k = F.col("key")
    keys = m.object_keys(spark, sf).where(t.is_volume_key(k))
    return keys.select("event_id", t.object_station(k).alias("station"), t.object_timestamp(k).alias("timestamp"))


@query(
    """SELECT DISTINCT strftime(d, '%Y/%m/%d') || '/' || st || '/' AS prefix FROM (
      SELECT 'K' || lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') AS st,
        unnest([CAST(ts AS DATE), CAST(ts AS DATE) - 1]) AS d FROM events)"""
)
def scan_prefixes(spark, sf):
    """Today's and yesterday's listing prefixes of every station and day."""
    station = F.concat(F.lit("K"), F.lpad((F.col("user_id") % 1000).cast("string"), 3, "0"))
    day = F.to_date("ts")
    days = m.table(spark, sf, "events").select(station.alias("st"), day.alias("d")).distinct()
    both = days.select("st", F.explode(F.array("d", F.date_sub("d", 1))).alias("d"))
    return both.select(t.day_prefix(F.col("d"), F.col("st")).alias("prefix")).distinct()


_SIN = "sin(elevation::DOUBLE * pi() / 180)"
_COS = "cos(elevation::DOUBLE * pi() / 180)"
_BASE = f"({g.EFFECTIVE_RADIUS_M!r}::DOUBLE + k::DOUBLE)"
_R = "range_m::DOUBLE"


@query(
    f"""WITH {m.RADIALS}, geo AS (SELECT msg_seq, azimuth,
        sqrt({_R} * {_R} + {_BASE} * {_BASE} + 2::DOUBLE * {_R} * {_BASE} * {_SIN}) - {g.EFFECTIVE_RADIUS_M!r}::DOUBLE AS h,
        atan2({_R} * {_COS}, {_BASE} + {_R} * {_SIN}) AS theta, {_BASE} AS base FROM rad)
      SELECT msg_seq, CAST(floor(h * 1000 + 0.5) AS BIGINT) AS h_mm,
        CAST(floor({g.EFFECTIVE_RADIUS_M!r}::DOUBLE * theta * sin(azimuth::DOUBLE * pi() / 180) * 1000 + 0.5) AS BIGINT) AS x_mm,
        CAST(floor({g.EFFECTIVE_RADIUS_M!r}::DOUBLE * theta * cos(azimuth::DOUBLE * pi() / 180) * 1000 + 0.5) AS BIGINT) AS y_mm,
        CAST(floor((({g.EFFECTIVE_RADIUS_M!r}::DOUBLE + h) * cos(theta) - base) * 1000 + 0.5) AS BIGINT) AS z_mm FROM geo"""
)
def beam_geometry(spark, sf):
    r, az, el, h = F.col("range_m"), F.col("azimuth"), F.col("elevation"), F.col("k")

    def mm(x):
        return F.floor(x * 1000 + F.lit(0.5))

    return m.radials(spark, sf).select(
        "msg_seq",
        mm(g.beam_height(r, el, h)).alias("h_mm"),
        mm(g.beam_x(r, az, el, h)).alias("x_mm"),
        mm(g.beam_y(r, az, el, h)).alias("y_mm"),
        mm(g.beam_z(r, el, h)).alias("z_mm"),
    )


@query(
    f"""WITH {m.INDEX} SELECT filename, CAST(CASE WHEN filename = 'volumetric.RDA' THEN 0
        ELSE CAST(replace(filename, '.RDA', '') AS DOUBLE) * 10 END AS INTEGER) AS tilt_tenths, count(*) AS n FROM idx GROUP BY ALL"""
)
def tilt_file_names(spark, sf):
    """File name to tilt and back to the name."""
    named = m.index(spark, sf).withColumn("tilt", t.file_tilt(F.col("filename")))
    back = F.when(F.col("filename") == t.VOLUME_FILE, F.col("filename")).otherwise(t.tilt_file(F.col("tilt")))
    return (
        named.groupBy(back.alias("filename"), F.round(F.col("tilt") * 10, 0).cast("int").alias("tilt_tenths"))
        .agg(F.count("*").alias("n"))
    )


@query(
    """WITH d AS (SELECT doc_id, n_chars * n_chars * (doc_id % 40 + 1) * (CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 1000 END) AS n FROM documents)
      SELECT doc_id, CASE WHEN n < 1024 THEN printf('%.2f B', n::DOUBLE) WHEN n < 1048576 THEN printf('%.2f KB', n::DOUBLE / 1024)
        WHEN n < 1073741824 THEN printf('%.2f MB', n::DOUBLE / 1048576) WHEN n < 1099511627776 THEN printf('%.2f GB', n::DOUBLE / 1073741824)
        ELSE printf('%.2f TB', n::DOUBLE / 1099511627776) END AS size FROM d"""
)
def human_sizes(spark, sf):
    factor = F.when(F.col("doc_id") % 3 == 0, F.lit(1)).otherwise(F.lit(1000))
    n = F.col("n_chars") * F.col("n_chars") * (F.col("doc_id") % 40 + 1) * factor
    docs = m.table(spark, sf, "documents").select("doc_id", n.alias("n"))
    return docs.select("doc_id", t.human_size(F.col("n")).alias("size"))


@query(
    """SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'N/A' ELSE strftime(ts, '%H:%M:%S UTC') END AS clock FROM events"""
)
def clock_from_ns(spark, sf):
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("ts"))
    ns = F.when(F.col("event_id") % 10 == 0, F.lit(0)).otherwise(us * 1000)
    return m.table(spark, sf, "events").select("event_id", t.clock_from_ns(ns).alias("clock"))


@query(
    """SELECT o_orderkey, CAST(floor((o_custkey + 3) / 4) AS INTEGER) AS gates_4, CAST(o_custkey AS INTEGER) AS gates_1,
      CASE WHEN o_custkey % 5 = 0 THEN 230000 ELSE o_custkey % 5 * 100 END AS max_range FROM orders"""
)
def gate_downsampling(spark, sf):
    """Gate counts at two downsampling factors, and the default range where none is given."""
    n = F.col("o_custkey").cast("int")
    span = f.mul(F.col("o_custkey") % 5, 100.0)
    return m.table(spark, sf, "orders").select(
        "o_orderkey",
        q.downsampled_gates(n, 4).alias("gates_4"),
        q.downsampled_gates(n).alias("gates_1"),
        F.when(span <= 0, F.lit(pr.DEFAULT_RANGE_M)).otherwise(span).cast("bigint").alias("max_range"),
    )


@query("SELECT doc_id, base64(encode(text)) AS encoded FROM documents")
def base64_text(spark, sf):
    return m.table(spark, sf, "documents").select("doc_id", b.base64_plain(F.col("text").cast("binary")).alias("encoded"))


@query(
    """WITH h AS (SELECT page_id, hex(encode(html)) AS x, octet_length(encode(html)) AS n FROM pages)
      SELECT page_id, CAST(('0x' || substr(x, 1, 2)) AS INTEGER) AS u8, CAST(('0x' || substr(x, 3, 4)) AS INTEGER) AS u16,
        CAST(('0x' || substr(x, 7, 8)) AS BIGINT) AS u32,
        CASE WHEN CAST(('0x' || substr(x, n * 2 - 39, 4)) AS INTEGER) >= 32768 THEN CAST(('0x' || substr(x, n * 2 - 39, 4)) AS INTEGER) - 65536
          ELSE CAST(('0x' || substr(x, n * 2 - 39, 4)) AS INTEGER) END AS i16,
        n >= 20 + 72 AS fits FROM h"""
)
def be_decode(spark, sf):
    """Big-endian integers out of page bytes, also from the end of the page, and a bounds check."""
    blob = F.col("blob")
    pages = m.table(spark, sf, "pages").select("page_id", F.col("html").cast("binary").alias("blob"))
    return pages.select(
        "page_id",
        b.be_u8(blob, 0).alias("u8"),
        b.be_u16(blob, 1).alias("u16"),
        b.be_u32(blob, 3).alias("u32"),
        b.be_i16(blob, F.octet_length(blob) - 20).cast("int").alias("i16"),
        b.has_bytes(blob, 20, 72).alias("fits"),
    )


_BITS = "CAST(('0x' || substr(hex(encode(substr(text, 1, 20))), 3, 8)) AS BIGINT)"


@query(
    f"""SELECT doc_id, CAST(floor(CASE WHEN bits >= 2147483648 THEN -1::DOUBLE ELSE 1::DOUBLE END * (8388608 + bits % 8388608)::DOUBLE
        * pow(2::DOUBLE, (bits // 8388608) % 256 - 150) * 1000 + 0.5) AS BIGINT) AS milli
      FROM (SELECT doc_id, 1090519040 + {_BITS} % 16777216 AS bits FROM documents)"""
)
def be_float_decode(spark, sf):
    """Four bytes of text moved into the float32 range 8..32, read back as a big-endian float."""
    bits = F.lit(0x41000000) + b.be_u32(F.substring("text", 1, 20).cast("binary"), 1) % 0x1000000
    blob = F.unhex(F.lpad(F.hex(bits), 8, "0"))
    docs = m.table(spark, sf, "documents").select("doc_id", blob.alias("blob"))
    return docs.select("doc_id", F.floor(b.be_f32(F.col("blob"), 0).cast("double") * 1000 + F.lit(0.5)).alias("milli"))


@query(
    """SELECT l_linenumber * 10 AS ptr, l_quantity AS need, l_partkey % 60 AS size,
      l_partkey % 60 >= l_linenumber * 10 + CAST(l_quantity AS INTEGER) AND (l_linenumber * 10) % 70 <> 0 AS ok, count(*) AS n
      FROM lineitem GROUP BY ALL"""
)
def pointer_checks(spark, sf):
    li = m.table(spark, sf, "lineitem")
    ptr, need, size = F.col("l_linenumber") * 10, F.col("l_quantity").cast("int"), F.col("l_partkey") % 60
    ok = b.pointer_ok(F.when(ptr % 70 == 0, F.lit(0)).otherwise(ptr), need, size)
    return li.groupBy(ptr.alias("ptr"), F.col("l_quantity").alias("need"), size.alias("size"), ok.alias("ok")).agg(F.count("*").alias("n"))


_V = "CAST(CAST(value * 300 AS FLOAT) AS DOUBLE)"


@query(
    f"""SELECT event_id, CAST(CASE WHEN {_V} >= 65536 THEN 31744
        WHEN {_V} < pow(2::DOUBLE, -14) THEN floor({_V} * pow(2::DOUBLE, 24))
        ELSE (floor(log2({_V})) + 15) * 1024 + floor(({_V} / pow(2::DOUBLE, floor(log2({_V}))) - 1) * 1024) END AS INTEGER) AS bits
      FROM events"""
)
def half_float_bits(spark, sf):
    """Truncating float16; ranges from 65536 on become infinity."""
    return m.table(spark, sf, "events").select("event_id", b.f16_bits((F.col("value") * 300).cast("float")).alias("bits"))


@query(
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
      CASE WHEN event_id % 3 = 0 THEN '{"n":' || event_id || '}'
        ELSE '{"dualpol":{"sys_diff_refl":' || (event_id % 3) || '},"n":' || event_id || '}' END AS metadata FROM events"""
)
def json_metadata(spark, sf):
    """JSON read with a path, and written with an optional object that is left out when its value is zero."""
    refl = F.col("event_id") % 3
    dualpol = F.when(refl != 0, F.struct(refl.alias("sys_diff_refl")))
    return m.table(spark, sf, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.to_json(F.struct(dualpol.alias("dualpol"), F.col("event_id").alias("n"))).alias("metadata"),
    )


@query(
    """SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ',')) AS word FROM benchmark) GROUP BY ALL"""
)
def csv_split(spark, sf):
    words = m.table(spark, sf, "benchmark").select(F.explode(F.split("text", ",")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query(
    """SELECT user_id, station_rate, CAST(floor(per_min * 1000 + 0.5) AS BIGINT) AS per_min_milli FROM (
      SELECT user_id, CAST(floor(CASE WHEN count(*) = 0 THEN 0 ELSE 100.0::DOUBLE * count_if(event_type <> 'error') / count(*) END * 1000 + 0.5) AS BIGINT) AS station_rate,
        CASE WHEN user_id % 7 = 0 THEN 0::DOUBLE ELSE 60::DOUBLE * count_if(event_type <> 'error') / (user_id % 7) END AS per_min
      FROM events GROUP BY user_id)"""
)
def success_rates(spark, sf):
    """Success rate and frames per minute with their zero guards; error events are failures."""
    counts = m.table(spark, sf, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") != "error").alias("ok"), F.count_if(F.col("event_type") == "error").alias("bad")
    )
    return counts.select(
        "user_id",
        F.floor(t.success_rate(F.col("ok"), F.col("bad")) * 1000 + F.lit(0.5)).alias("station_rate"),
        F.floor(t.per_minute(F.col("ok"), F.col("user_id") % 7) * 1000 + F.lit(0.5)).alias("per_min_milli"),
    )


@query(
    f"""WITH {m.RADIALS} SELECT msg_seq, CAST(floor(CAST({m.sql_f('k')} * {m.sql_f(0.01)} AS DOUBLE) * 100000 + 0.5) AS BIGINT) AS nyquist_generic,
      CAST(floor(CAST({m.sql_f('k')} * {m.sql_f(0.1)} AS DOUBLE) * 100000 + 0.5) AS BIGINT) AS nyquist_legacy,
      CAST(k * 100 AS INTEGER) AS range_m, CAST(k - 40 + (msg_seq % 30) AS INTEGER) AS height_asl FROM rad"""
)
def radial_scaling(spark, sf):
    """Scaled radial fields: Nyquist velocity of both record kinds, unambiguous range, height above sea level."""
    k = F.col("k")
    scaled = [F.floor(f.mul(k, s).cast("double") * 100000 + F.lit(0.5)).alias(n) for s, n in ((0.01, "nyquist_generic"), (0.1, "nyquist_legacy"))]
    return m.radials(spark, sf).select(
        "msg_seq",
        *scaled,
        f.mul(k, 100.0).cast("int").alias("range_m"),
        f.add(k - 40, F.col("msg_seq") % 30).cast("int").alias("height_asl"),
    )
