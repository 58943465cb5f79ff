"""Decode queries on volumes that Spark writes from the events table."""

from __future__ import annotations

import bz2
import struct

import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import framing, metadata, pack, points, quality, raster
from ..plans import decode as d
from ..products import ALL_PRODUCTS
from ..session import materialize, scratch_path, scratch_scope
from ..sources import containers, rda
from . import mapping as m
from . import synth
from .registry import query

_PRODUCTS = ["reflectivity", "velocity"]
PROBE_STEP = 977  # prime, so that probes meet all rays and gates in turn

EVENTS = f"""ev AS (SELECT *, {synth.VOLUME_KEY_SQL} AS volume_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
    CAST((event_id // {synth.CUT_IDS}) % {len(synth.CUT_64THS)} AS INTEGER) AS cut,
    CAST(row_number() OVER (PARTITION BY {synth.VOLUME_KEY_SQL} ORDER BY event_id) - 1 AS INTEGER) AS msg_seq,
    CASE WHEN event_id % 29 = 0 THEN 0 ELSE 1 END AS status FROM events),
  el AS (SELECT *, CAST({synth.CUT_64THS}[cut + 1] AS DOUBLE) / 64 AS elev, lag(cut) OVER (PARTITION BY volume_id ORDER BY event_id) AS prev FROM ev),
  seg AS (SELECT *, CAST(sum(CASE WHEN status = 0 OR prev IS NULL OR prev <> cut THEN 1 ELSE 0 END)
    OVER (PARTITION BY volume_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS INTEGER) - 1 AS sweep_id FROM el)"""

RAW = f"""{EVENTS},
  ref AS (SELECT *, CAST(event_id % {synth.STRIDE} + j * {synth.STRIDE} AS INTEGER) AS gate FROM seg, range(0, {synth.GATES // synth.STRIDE}) r(j)),
  vel AS (SELECT *, CAST(j AS INTEGER) AS gate FROM seg, range(0, {synth.VEL_GATES}) r(j) WHERE event_id % 2 = 1),
  raw AS (SELECT volume_id, event_id, msg_seq, sweep_id, cut, elev, gate, 'reflectivity' AS product, CAST((event_id * 7 + gate * 13) % 256 AS INTEGER) AS raw, 66 AS off, {synth.GATES} AS ngates FROM ref
    UNION ALL SELECT volume_id, event_id, msg_seq, sweep_id, cut, elev, gate, 'velocity', CAST((event_id * 31 + gate * 101) % 1000 AS INTEGER), 129, {synth.VEL_GATES} FROM vel),
  val AS (SELECT *, CAST((event_id * 37) % 2880 AS DOUBLE) / 8 AS az, (raw - off) / 2.0::DOUBLE AS value FROM raw
    WHERE raw > 1 AND (product = 'velocity' OR (raw - off) / 2.0::DOUBLE >= -32))"""


def _decoded(spark, sf, gates=True):
    return d.decode(synth.volumes(spark, sf), _PRODUCTS, gates=gates)


@query(
    f"""WITH {EVENTS} SELECT volume_id, msg_seq, 31 AS type, CAST(event_id % 65536 AS INTEGER) AS sequence_num,
      CAST(24 + msg_seq * 648 AS BIGINT) AS "offset", 632 AS payload_bytes FROM ev"""
)
def frame_messages(spark, sf):
    """Unpacked volumes cut into messages: offset, type, sequence number, payload size."""
    rows = framing.frame_messages(synth.volumes(spark, sf))
    return rows.select("volume_id", "msg_seq", "type", "sequence_num", "offset", F.octet_length("payload").alias("payload_bytes"))


@query(
    f"""SELECT {synth.VOLUME_KEY_SQL} AS volume_id, CASE WHEN user_id % 3 = 1 THEN 'HINT' ELSE 'K' || lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') END AS station,
      CASE WHEN user_id % 3 = 1 THEN '20240101_000000' ELSE strftime(TIMESTAMP '2024-01-01 01:02:03' + to_seconds(user_id), '%Y%m%d_%H%M%S') END AS timestamp
      FROM events GROUP BY user_id, event_id // {synth.BLOCK_IDS}"""
)
def volume_headers(spark, sf):
    """Station and time from the volume header, which overrides the caller's hints."""
    return framing.volume_headers(synth.volumes(spark, sf))


@query(
    f"""WITH {EVENTS} SELECT volume_id, msg_seq, sequence_num, previous FROM (SELECT volume_id, msg_seq, CAST(event_id % 65536 AS INTEGER) AS sequence_num,
        lag(CAST(event_id % 65536 AS INTEGER)) OVER (PARTITION BY volume_id ORDER BY msg_seq) AS previous FROM ev)
      WHERE previous IS NOT NULL AND sequence_num <> (previous + 1) % 65536"""
)
def volume_sequence_gaps(spark, sf):
    """Sequence gaps of the framed messages."""
    rows = framing.frame_messages(synth.volumes(spark, sf), keep_types=())
    return quality.sequence_gaps(rows, ["volume_id"]).select("volume_id", "msg_seq", "sequence_num", "previous")


@query(
    f"""WITH {EVENTS} SELECT volume_id, sweep_id, min(msg_seq) AS start_seq, max(msg_seq) AS end_seq, CAST(arg_min(elev, msg_seq) * 64 AS INTEGER) AS elev64,
      arg_min(cut, msg_seq) + 1 AS elev_num, CAST(count(*) AS INTEGER) AS ray_count FROM seg GROUP BY ALL"""
)
def decode_sweeps(spark, sf):
    """Sweeps of the decoded volumes."""
    rows = _decoded(spark, sf, gates=False).sweeps
    return rows.select("volume_id", "sweep_id", "start_seq", "end_seq", (F.col("elevation_deg") * 64).cast("int").alias("elev64"), "elev_num", "ray_count")


@query(
    f"""WITH {EVENTS}, p AS (SELECT * FROM (VALUES ('reflectivity'), ('velocity')) t(product)),
      per AS (SELECT volume_id, any_value(user_id) AS u, max_by(k, msg_seq) AS k, count(DISTINCT sweep_id) AS nsweeps, count(*) AS nrays,
        arg_min(elev, msg_seq) AS e0, max((k % 3) * k) AS max_ur, max_by((k % 3) * k, msg_seq) FILTER ((k % 3) * k > 0) AS last_ur,
        count(*) FILTER (event_id % 2 = 1) AS vel, count(DISTINCT cut) AS ntilts FROM seg GROUP BY 1)
      SELECT volume_id, product, CASE WHEN u % 3 = 1 THEN 'HINT' ELSE 'K' || lpad(CAST(u % 1000 AS VARCHAR), 3, '0') END AS station,
        CAST(200 + k AS INTEGER) AS vcp, CAST(370 + k AS INTEGER) AS height, CAST(k AS INTEGER) AS refl8, 355 AS lat10, CAST(nsweeps AS INTEGER) AS nsweeps,
        CAST(nrays AS INTEGER) AS nrays, CAST(e0 * 64 AS INTEGER) AS elev64, CAST(ntilts AS INTEGER) AS ntilts,
        CASE WHEN max_ur > 0 THEN CAST(max_ur * 100 AS INTEGER) ELSE 230000 END AS max_range, CAST(coalesce(last_ur * 100, 230000) AS INTEGER) AS unambiguous_range,
        CASE WHEN product = 'reflectivity' THEN {synth.GATES} WHEN vel > 0 THEN {synth.VEL_GATES} ELSE 0 END AS ngates,
        CASE WHEN product = 'reflectivity' OR vel > 0 THEN {synth.FIRST_GATE} ELSE 0 END AS first_gate FROM per, p"""
)
def decode_frames(spark, sf):
    """Frame metadata per volume and product: last site values, first geometry, ranges, counts."""
    f = _decoded(spark, sf, gates=False).frames

    def whole(x):
        return F.round(x, 0).cast("int")

    return f.select(
        "volume_id",
        "product",
        "station",
        "vcp",
        whole(F.col("height_asl")).alias("height"),
        whole(F.col("sys_diff_refl") * 8).alias("refl8"),
        whole(F.col("lat") * 10).alias("lat10"),
        "nsweeps",
        "nrays",
        whole(F.col("elevation_deg") * 64).alias("elev64"),
        F.size("available_tilts").alias("ntilts"),
        whole(F.col("max_range")).alias("max_range"),
        whole(F.col("unambiguous_range")).alias("unambiguous_range"),
        "ngates",
        whole(F.col("first_gate")).alias("first_gate"),
    )


@query(
    f"""WITH {RAW} SELECT volume_id, product, sweep_id, msg_seq, gate, CAST(az * 8 AS INTEGER) AS az8, {synth.FIRST_GATE} + gate * {synth.SPACING} AS range_m,
      CAST(value * 10 AS INTEGER) AS tenths FROM val"""
)
def decode_bins(spark, sf):
    """Every gate with data: azimuth, range, value."""
    b = _decoded(spark, sf).bins()
    return b.select(
        "volume_id",
        "product",
        "sweep_id",
        "msg_seq",
        "gate",
        (F.col("azimuth") * 8).cast("int").alias("az8"),
        F.col("range_m").cast("int").alias("range_m"),
        F.round(F.col("value") * 10, 0).cast("int").alias("tenths"),
    )


_SEG_NYQ = "CAST(max_by((k % 4) * 100, msg_seq) FILTER ((k % 4) > 0) AS INTEGER)"


@query(f"WITH {EVENTS} SELECT volume_id, sweep_id, {_SEG_NYQ} AS nyquist_cm FROM seg GROUP BY ALL HAVING count(*) FILTER (k % 4 > 0) > 0")
def decode_nyquist(spark, sf):
    """Last Nyquist velocity given in each sweep."""
    dec = _decoded(spark, sf, gates=False)
    rows = metadata.sweep_nyquist(dec.ranges, dec.sweeps)
    return rows.select("volume_id", "sweep_id", F.round(F.col("nyquist_all") * 100, 0).cast("int").alias("nyquist_cm"))


# Elevations of the written volumes are far apart, so a tilt's sweeps are those of its cut. A tilt never has more
# than 400 rays here except for very busy users, which the CASE covers.
_TILTS = """tc AS (SELECT volume_id, cut, any_value(elev) AS tilt, CAST(count(*) AS INTEGER) AS rays FROM seg GROUP BY volume_id, cut),
  tl AS (SELECT *, CASE WHEN rays > 400 THEN 720 ELSE 360 END AS num_rays,
    CAST(row_number() OVER (PARTITION BY volume_id ORDER BY tilt) - 1 AS INTEGER) AS tilt_idx FROM tc)"""


def _cells_sql(three_d: bool) -> str:
    q_ref, q_vel = m.sql_quantize("value", -32, 94.5), m.sql_quantize("value", -100, 100)
    fine = "CAST(floor(az * 2 + 0.01) AS INTEGER) % 720"
    ray = fine if three_d else f"CASE WHEN num_rays = 720 THEN {fine} ELSE CAST(floor(az + 0.01) AS INTEGER) % 360 END"
    base = f"""WITH {RAW}, {_TILTS}, placed AS (SELECT volume_id, product, tilt_idx, num_rays, {ray} AS ray, gate, ngates,
        CASE product WHEN 'velocity' THEN {q_vel} ELSE {q_ref} END AS q FROM val JOIN tl USING (volume_id, cut)), kept AS (SELECT * FROM placed WHERE q > 0)"""
    if three_d:
        return f"""{base}, filled AS (SELECT volume_id, product, tilt_idx, ray, gate, q FROM kept
            UNION ALL SELECT volume_id, product, tilt_idx, (ray + 1) % 720, gate, q FROM kept WHERE num_rays = 360)
          SELECT volume_id, product, tilt_idx, ray, gate, max(q) AS q FROM filled GROUP BY ALL"""
    return f"{base} SELECT volume_id, product, tilt_idx, num_rays, ray, gate, max(q) AS q FROM kept GROUP BY ALL"


@query(_cells_sql(False))
def packed_tilts(spark, sf):
    """2-D grids packed per tilt, then unpacked into cells."""
    packs = _decoded(spark, sf).tilt_packs(slabs=False)
    keys = ["volume_id", "product", "tilt_idx", "num_rays", "num_gates"]
    cells = pack.unpack_cells(packs, keys)
    placed = pack.grid_cells(cells, F.col("num_gates"), 0.0, 255.0)
    return placed.select("volume_id", "product", "tilt_idx", "num_rays", "ray", "gate", "q")


@query(_cells_sql(True))
def packed_volumes(spark, sf):
    """The 720-ray volumes put together from tilt slabs, then unpacked into cells."""
    whole = raster.volume_packs(_decoded(spark, sf).tilt_packs())
    cells = pack.grid_cells(pack.unpack_cells(whole, ["volume_id", "product", "num_gates"]), F.col("num_gates"), 0.0, 255.0)
    ray = F.col("ray")
    return cells.select(
        "volume_id", "product", F.floor(ray / 720).cast("int").alias("tilt_idx"), (ray % 720).cast("int").alias("ray"), "gate", "q"
    )


@query(_cells_sql(False))
def decoded_cells_2d(spark, sf):
    """The same 2-D grids from bin rows, by joins and a maximum per cell."""
    dec = _decoded(spark, sf)
    return raster.cells_2d(dec.cut_bins()).select("volume_id", "product", "tilt_idx", "num_rays", "ray", "gate", "q")


@query(_cells_sql(True))
def decoded_cells_3d(spark, sf):
    dec = _decoded(spark, sf)
    return raster.cells_3d(dec.cut_bins()).select("volume_id", "product", "tilt_idx", "ray", "gate", "q")


_FILES = f"""WITH {RAW}, {_TILTS}, pt AS (SELECT volume_id, p.product FROM (SELECT DISTINCT volume_id FROM seg) v, (VALUES ('reflectivity'), ('velocity')) p(product)
    WHERE p.product = 'reflectivity' OR volume_id IN (SELECT volume_id FROM seg WHERE event_id % 2 = 1)),
  named AS (SELECT DISTINCT volume_id, user_id, CASE WHEN user_id % 3 = 1 THEN 'HINT' ELSE 'K' || lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') END AS station FROM seg)"""


@query(
    f"""{_FILES} SELECT station, product, printf('%.1f.RDA', tilt) AS filename, num_rays AS r,
        CASE product WHEN 'velocity' THEN {synth.VEL_GATES} ELSE {synth.GATES} END AS g, CAST(tilt * 64 AS INTEGER) AS e64, count(*) AS n
      FROM pt JOIN tl USING (volume_id) JOIN named USING (volume_id) GROUP BY ALL"""
)
def tilt_file_metadata(spark, sf):
    """Metadata of the packed tilt files, read back from their JSON."""
    dec = _decoded(spark, sf)
    files = rda.parsed_metadata(rda.tilt_files(dec.tilt_packs(slabs=False), dec.frames))
    cols = [F.col("meta.r").alias("r"), F.col("meta.g").alias("g"), (F.col("meta.e") * 64).cast("int").alias("e64")]
    return files.select("station", "product", "filename", *cols).groupBy("station", "product", "filename", "r", "g", "e64").agg(F.count("*").alias("n"))


# A station and timestamp belong to one user; volumes without a header share the hint. Files of one path are one file.
@query(
    f"""{_FILES}, owner AS (SELECT DISTINCT volume_id, CASE WHEN user_id % 3 = 1 THEN 'HINT' ELSE CAST(user_id AS VARCHAR) END AS site FROM seg),
  path AS (SELECT site, product, printf('%.1f.RDA', tilt) AS filename FROM pt JOIN tl USING (volume_id) JOIN owner USING (volume_id)
    UNION SELECT site, product, 'volumetric.RDA' FROM val JOIN owner USING (volume_id)
    WHERE CASE product WHEN 'velocity' THEN {m.sql_quantize('value', -100, 100)} ELSE {m.sql_quantize('value', -32, 94.5)} END > 0)
  SELECT product, count(*) AS files, CAST(0 AS BIGINT) AS different FROM path GROUP BY product"""
)
def rda_round_trip(spark, sf):
    """Files written in the packed format, read back, and compared with what was written: files and differing ones."""
    base = scratch_path(spark, "rda")
    volumes = synth.volumes(spark, sf)  # are kept for other queries
    written = scratch_path(spark, "files")
    with scratch_scope(spark):  # nothing of the decode stays on disk beside the export
        files = rda.one_per_path(d.frame_files(d.decode(volumes, _PRODUCTS)))
        files.write.option("compression", "zstd").parquet(written)
    rda.export_rda(spark.read.parquet(written), base)
    keys = ["station", "product", "timestamp", "filename"]
    stored = spark.read.parquet(written).select(*keys, F.md5(F.concat(F.col("metadata").cast("binary"), "bitmask", "values")).alias("want"))
    back = rda.read_rda(spark, base).select(*keys, F.md5(F.concat(F.col("metadata").cast("binary"), "bitmask", "values")).alias("got"))
    joined = stored.join(back, keys, "full")
    return joined.groupBy("product").agg(F.count("*").alias("files"), F.count_if(~F.equal_null("want", "got")).alias("different"))


@query(
    f"""WITH {RAW}, site AS (SELECT volume_id, 370 + max_by(k, msg_seq) AS h FROM seg GROUP BY 1),
      p AS (SELECT val.*, h + {8494666.666666666!r}::DOUBLE AS base, ({synth.FIRST_GATE} + gate * {synth.SPACING})::DOUBLE AS r, elev * pi() / 180 AS e, az * pi() / 180 AS a
        FROM val JOIN site USING (volume_id) WHERE value > -100),
      geo AS (SELECT *, atan2(r * cos(e), base + r * sin(e)) AS theta, sqrt(r * r + base * base + 2::DOUBLE * r * base * sin(e)) - {8494666.666666666!r}::DOUBLE AS ht FROM p)
      SELECT volume_id, product, count(*) AS n, CAST(round(sum({8494666.666666666!r}::DOUBLE * theta * sin(a)) / count(*)) AS BIGINT) AS mean_x,
        CAST(round(sum({8494666.666666666!r}::DOUBLE * theta * cos(a)) / count(*)) AS BIGINT) AS mean_y,
        CAST(round(sum(({8494666.666666666!r}::DOUBLE + ht) * cos(theta) - base) / count(*)) AS BIGINT) AS mean_z FROM geo GROUP BY ALL"""
)
def points_3d(spark, sf):
    """Mean position of the points of every frame, to the metre. Means of single-precision points would round to another metre
    where the mean lies close to half a one."""
    dec = _decoded(spark, sf)
    pts = points.positions(dec.point_bins())
    means = [F.round(F.avg(c), 0).cast("bigint").alias(f"mean_{c}") for c in "xyz"]
    return pts.groupBy("volume_id", "product").agg(F.count("*").alias("n"), *means)


@query(
    f"""WITH {RAW} SELECT volume_id, product, CAST(ceil(count(*) * 8 / 3.0) * 4 AS BIGINT) AS chars FROM val WHERE value > -100 GROUP BY ALL"""
)
def points_f16(spark, sf):
    """Length of the base64 text of each frame's half-precision points."""
    dec = _decoded(spark, sf)
    pts = points.to_points3d(dec.point_bins())
    return points.encode_points_f16(pts).select("volume_id", "product", F.length("encoded").cast("bigint").alias("chars"))


@query(
    f"""{_FILES.replace("('reflectivity'), ('velocity')", "('reflectivity')")} SELECT filename, count(*) AS n FROM
      (SELECT printf('%.1f.RDA', tilt) AS filename FROM pt JOIN tl USING (volume_id)
       UNION ALL SELECT 'volumetric.RDA' FROM (SELECT DISTINCT volume_id FROM val WHERE product = 'reflectivity' AND value > -32
         AND (value + 32) / 127 * 255 >= 1)) GROUP BY ALL"""
)
def offline_conversion(spark, sf):
    """Single-file conversion of every volume in the offline dialect: one file per tilt and one per volume."""
    rows = d.offline_files(synth.volumes(spark, sf))
    return rows.groupBy("filename").agg(F.count("*").alias("n"))


@F.pandas_udf(T.BinaryType())
def _containers(doc_id: pd.Series, data: pd.Series) -> pd.Series:
    def one(i: int, text: bytes) -> bytes:
        head = b"AR2V0006.001".ljust(24, b"\1")
        half = len(text) // 2
        if i % 5 == 0:
            return bz2.compress(text, 1)
        if i % 5 == 1:
            parts = [bz2.compress(text[:half], 1), bz2.compress(text[half:], 1)]
            return head + struct.pack(">i", len(parts[0])) + parts[0] + struct.pack(">i", -len(parts[1])) + parts[1]
        if i % 5 == 2:
            return head + bz2.compress(text, 1)
        if i % 5 == 3:
            good, cut = bz2.compress(text[:half], 1), bz2.compress(text[half:], 1)[:-4]
            return head + struct.pack(">i", len(good)) + good + struct.pack(">i", len(cut)) + cut
        return head + text

    return pd.Series([one(*row) for row in zip(doc_id, data)])


@F.pandas_udf(T.BinaryType())
def _unpacked(data: pd.Series) -> pd.Series:
    return data.map(containers.unpack_volume)


@query(
    """SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN lower(hex(encode(text))) WHEN 2 THEN lower(hex(encode(text)))
      WHEN 3 THEN head || substr(lower(hex(encode(text))), 1, (octet_length(encode(text)) // 2) * 2) ELSE head || lower(hex(encode(text))) END AS plain
      FROM (SELECT *, lower(hex(encode('AR2V0006.001'))) || repeat('01', 12) AS head FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents))"""
)
def container_round_trip(spark, sf):
    """Documents packed into each container form, one of them with a cut record, then unpacked."""
    docs = m.table(spark, sf, "documents").select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    plain = _unpacked(_containers(F.col("doc_id"), F.col("data")))
    return docs.select("doc_id", F.lower(F.hex(plain)).alias("plain"))


GZIP_ROWS = 64  # texts that are packed before what came of them leaves


def _gzip_round(batches):
    for batch in (b.slice(at, GZIP_ROWS) for b in batches for at in range(0, b.num_rows, GZIP_ROWS)):
        plain = []
        for i, x in zip(batch.column(0).to_pylist(), batch.column(1)):
            packed = containers.gzip_best(x.as_py())
            plain.append(containers.gunzip(packed[:-3] if i is not None and i % 4 == 0 else packed))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(plain, pa.binary())], names=["doc_id", "plain"])


@query("SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN md5('') ELSE md5(text) END AS digest FROM documents")
def gzip_round_trip(spark, sf):
    """Gzip and back; a cut file gives nothing."""
    docs = m.table(spark, sf, "documents").select("doc_id", F.col("text").cast("binary").alias("data"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_gzip_round, f"doc_id {kind}, plain binary").select("doc_id", F.md5("plain").alias("digest"))


@query("SELECT doc_id, CAST(octet_length(encode(text)) // 7 AS INTEGER) AS n_triplets, CASE WHEN octet_length(encode(text)) > 4 THEN CAST(('0x' || substr(hex(encode(text)), 9, 2)) AS INTEGER) END AS example_value FROM documents")
def legacy_triplets(spark, sf):
    """Triplets of the legacy text form: JSON whose ``d`` is base64."""
    docs = m.table(spark, sf, "documents")
    text = F.to_json(F.struct(F.lit("q").alias("f"), F.base64(F.col("text").cast("binary")).alias("d")))
    return rda.legacy_triplets(docs.select("doc_id", text.alias("metadata"))).select("doc_id", "n_triplets", "example_value")


@query(
    """WITH pieces AS (SELECT l_orderkey, l_linenumber AS number, max(l_linenumber) OVER (PARTITION BY l_orderkey) AS n, l_returnflag || l_linestatus AS p,
        row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, l_returnflag || l_linestatus) AS r FROM lineitem)
      SELECT l_orderkey, count(*) AS segments, string_agg(p, '' ORDER BY number) AS text FROM pieces WHERE r = 1
      GROUP BY l_orderkey, n HAVING count(*) = n"""
)
def segment_assembly(spark, sf):
    """Order lines as message segments: first copy wins, complete when all numbers are there, joined in order."""
    li = m.table(spark, sf, "lineitem")
    order = ["l_suppkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"]
    piece = F.concat("l_returnflag", "l_linestatus")
    first = li.groupBy("l_orderkey", "l_linenumber").agg(F.min_by(piece, F.struct(*order, piece.alias("p"))).alias("p"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "p"))), lambda x: x["p"]), "")
    whole = first.groupBy("l_orderkey").agg(F.count("*").alias("segments"), F.max("l_linenumber").alias("n"), joined.alias("text"))
    return whole.where(F.col("segments") == F.col("n")).select("l_orderkey", "segments", "text")


@query(
    f"""WITH {RAW}, {_TILTS}, cell AS (SELECT volume_id, tilt_idx, CASE WHEN num_rays = 720 THEN CAST(floor(az * 2 + 0.01) AS INTEGER) % 720 ELSE CAST(floor(az + 0.01) AS INTEGER) % 360 END AS ray,
        gate, max({m.sql_quantize('value', -32, 94.5)}) AS q FROM val JOIN tl USING (volume_id, cut) WHERE product = 'reflectivity' AND {m.sql_quantize('value', -32, 94.5)} > 0 GROUP BY ALL),
      probe AS (SELECT volume_id, tilt_idx, unnest(range(0, CAST(num_rays AS BIGINT) * {synth.GATES}, {PROBE_STEP})) AS bit_idx FROM tl)
      SELECT volume_id, tilt_idx, bit_idx, q FROM probe JOIN cell USING (volume_id, tilt_idx)
      WHERE bit_idx = CAST(cell.ray AS BIGINT) * {synth.GATES} + cell.gate"""
)
def packed_lookup(spark, sf):
    """Values of single cells read straight from the packed form, by bit positions spread over each whole grid; cells without
    data left out."""
    packs = _decoded(spark, sf).tilt_packs(slabs=False).where(F.col("product") == "reflectivity")
    last = F.greatest(F.octet_length("bitmask").cast("bigint") * 8 - 1, F.lit(0).cast("bigint"))
    bits = F.sequence(F.lit(0).cast("bigint"), last, F.lit(PROBE_STEP).cast("bigint"))
    codes = packs.select("volume_id", "tilt_idx", bits.alias("bit_idx"), pack.values_at("bitmask", "values", bits).alias("q"))
    found = codes.select("volume_id", "tilt_idx", F.explode(F.arrays_zip("bit_idx", "q")).alias("cell"))
    return found.select("volume_id", "tilt_idx", "cell.bit_idx", "cell.q").where(F.col("q") > 0)


_FINE = "CAST(floor(az * 2 + 0.01) AS INTEGER) % 720"


@query(
    f"""WITH {RAW}, {_TILTS}, cell AS (SELECT volume_id, product, tilt_idx, num_rays, gate, ngates, {_FINE} AS fine,
        CASE WHEN num_rays = 720 THEN {_FINE} ELSE CAST(floor(az + 0.01) AS INTEGER) % 360 END AS ray,
        CASE product WHEN 'velocity' THEN {m.sql_quantize('value', -100, 100)} ELSE {m.sql_quantize('value', -32, 94.5)} END AS q FROM val JOIN tl USING (volume_id, cut)),
      full_ray AS (SELECT volume_id, product, tilt_idx, gate, ngates, unnest(CASE WHEN num_rays = 360 THEN [fine, (fine + 1) % 720] ELSE [fine] END) AS ray, q FROM cell),
      placed AS (SELECT 'tilt' AS kind, volume_id, product, tilt_idx, CAST(ray AS BIGINT) * ngates + gate AS bit_idx, q FROM cell
        UNION ALL SELECT 'volume', volume_id, product, -1, (CAST(tilt_idx AS BIGINT) * 720 + ray) * ngates + gate, q FROM full_ray)
      SELECT kind, volume_id, product, tilt_idx, bit_idx, max(q) AS q FROM placed WHERE q > 0 AND bit_idx % {PROBE_STEP} = 0 GROUP BY ALL"""
)
def packed_lookup_directory(spark, sf):
    """Cells of tilts and whole volumes, all products, read through the stored rank directory by Spark expressions alone; bit
    positions spread over each whole grid, cells without data left out."""
    tilts = materialize(d.decode(synth.volumes(spark, sf), ALL_PRODUCTS).tilt_packs(), "packs")
    whole = raster.volume_packs(tilts).select(F.lit("volume").alias("kind"), "volume_id", "product", F.lit(-1).alias("tilt_idx"), "bitmask", "values")
    packs = whole.unionByName(tilts.select(F.lit("tilt").alias("kind"), "volume_id", "product", "tilt_idx", "bitmask", "values"))
    stored = materialize(pack.with_directory(packs), "directory")
    return _probed(stored)


def _probed(stored):
    last = F.greatest(F.octet_length("bitmask").cast("bigint") * 8 - 1, F.lit(0).cast("bigint"))
    bits = F.sequence(F.lit(0).cast("bigint"), last, F.lit(PROBE_STEP).cast("bigint"))
    read = F.filter(pack.codes_at(bits), lambda c: c["q"] > 0)
    found = stored.select("kind", "volume_id", "product", "tilt_idx", F.explode(read).alias("cell"))
    return found.select("kind", "volume_id", "product", "tilt_idx", "cell.bit_idx", "cell.q")
