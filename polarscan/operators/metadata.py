"""Per-sweep and per-volume metadata. Stream order is always ``(msg_seq, block_no)``; aggregates combine map-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import products as pr
from ..functions import f32 as f
from ..functions import quantize as q

GEOMETRY_MIN_GATES = 10
EMPTY_ELEVATION = 999.0


BLOCK_SLOTS = 16


def stream_order() -> Column:
    """Position of a block in its volume, as one number: aggregates over plain numbers hash, over structs they sort."""
    return F.col("msg_seq").cast("bigint") * BLOCK_SLOTS + F.col("block_no")


def first_by(value: Column, order: Column, where: Column) -> Column:
    """Value of the first row, in ``order``, that satisfies ``where``."""
    return F.min_by(value, F.when(where, order))


def last_by(value: Column, order: Column, where: Column) -> Column:
    return F.max_by(value, F.when(where, order))


def first_geometry(moments: DataFrame, keys: list[str]) -> DataFrame:
    """Gate geometry of the first moment with more than ten gates; it then applies to all sweeps."""
    order = stream_order()
    usable = moments.where(F.col("num_gates") > GEOMETRY_MIN_GATES)
    return usable.groupBy(*keys).agg(
        q.downsampled_gates(F.min_by("num_gates", order)).alias("ngates"),
        F.min_by("first_gate", order).alias("first_gate"),
        F.min_by("gate_spacing", order).alias("gate_spacing"),
    )


def sweeps(segmented: DataFrame) -> DataFrame:
    """One row per sweep; its elevation is that of its first radial."""
    return (
        segmented.groupBy("volume_id", "sweep_id")
        .agg(
            F.min("msg_seq").alias("start_seq"),
            F.max("msg_seq").alias("end_seq"),
            F.min_by("elevation", "msg_seq").alias("elevation_deg"),
            F.min_by("elev_num", "msg_seq").alias("elev_num"),
            F.count("*").cast("int").alias("ray_count"),
        )
        .withColumn("tilt_key", q.tilt_key(F.col("elevation_deg")))
    )


def tilt_ray_counts(sweep_rows: DataFrame) -> DataFrame:
    """Rays per tilt key, over all sweeps that share the key."""
    return sweep_rows.groupBy("volume_id", "tilt_key").agg(F.sum("ray_count").cast("int").alias("tilt_rays"))


def tilts(sweep_rows: DataFrame) -> DataFrame:
    """Distinct sweep elevations, ascending, as one array per volume."""
    return sweep_rows.groupBy("volume_id").agg(F.sort_array(F.collect_set("elevation_deg")).alias("available_tilts"))


def sweep_nyquist(ranges: DataFrame, sweep_rows: DataFrame) -> DataFrame:
    """Last non-zero Nyquist velocity per sweep, for generic radials and for legacy ones."""
    order = stream_order()
    generic = F.col("msg_type") == 31
    last = (
        ranges.where(F.col("nyquist") > 0)
        .groupBy("volume_id", "sweep_id")
        .agg(
            last_by(F.col("nyquist"), order, generic).alias("nyquist_all"),
            F.max_by("nyquist", order).alias("nyquist_reflectivity"),
            F.max("msg_seq").alias("nyquist_seq"),
        )
    )
    return last.join(sweep_rows.select("volume_id", "sweep_id", "tilt_key"), ["volume_id", "sweep_id"])


def frames(
    headers: DataFrame,
    products: list[str],
    segmented: DataFrame,
    sweep_rows: DataFrame,
    sites: DataFrame,
    ranges: DataFrame,
    geometry: DataFrame,
) -> DataFrame:
    """One row per (volume, product), also for volumes without a usable radial."""
    order = stream_order()
    site_cols = ["lat", "lon", "height_asl", "vcp", "sys_diff_refl", "sys_diff_phase"]
    site = sites.groupBy("volume_id").agg(*[F.max_by(c, order).alias(c) for c in site_cols])
    span = F.col("unambiguous_range")
    generic = F.col("msg_type") == 31
    reach = ranges.groupBy("volume_id").agg(
        last_by(span, order, (span > 0) & generic).alias("last_all"),
        last_by(span, order, span > 0).alias("last_refl"),
        F.max(F.when(generic, span)).alias("max_all"),
        F.max(span).alias("max_refl"),
    )
    counts = segmented.groupBy("volume_id").agg(
        F.count("*").cast("int").alias("nrays"),
        F.min("elevation").alias("min_elevation"),
        F.min_by("elevation", "msg_seq").alias("first_elevation"),
    )
    per_volume = sweep_rows.groupBy("volume_id").agg(
        F.count("*").cast("int").alias("nsweeps"),
        F.sort_array(F.collect_set("elevation_deg")).alias("available_tilts"),
    )
    listed = headers.withColumn("product", F.explode(F.array(*[F.lit(p) for p in products])))
    is_refl = pr.moment_code_of(F.col("product")) == 1

    def metres(refl: str, other: str) -> Column:
        value = F.coalesce(F.when(is_refl, F.col(refl)).otherwise(F.col(other)), f.f32(0.0))
        return F.when(value <= 0, f.f32(pr.DEFAULT_RANGE_M)).otherwise(value).cast("float")

    zero = {"nrays": 0, "nsweeps": 0, "ngates": 0}
    return (
        listed.join(per_volume, "volume_id", "left")
        .join(counts, "volume_id", "left")
        .join(site, "volume_id", "left")
        .join(reach, "volume_id", "left")
        .join(geometry, ["volume_id", "product"], "left")
        .fillna(zero)
        .select(
            "volume_id",
            "station",
            "timestamp",
            "product",
            F.coalesce("lat", F.lit(0.0)).alias("lat"),
            F.coalesce("lon", F.lit(0.0)).alias("lon"),
            F.coalesce("height_asl", f.f32(0.0)).alias("height_asl"),
            F.coalesce("vcp", F.lit(0)).alias("vcp"),
            "nsweeps",
            "ngates",
            "nrays",
            F.coalesce("gate_spacing", f.f32(0.0)).alias("gate_spacing"),
            F.coalesce("first_gate", f.f32(0.0)).alias("first_gate"),
            metres("max_refl", "max_all").alias("max_range"),
            metres("last_refl", "last_all").alias("unambiguous_range"),
            F.coalesce("sys_diff_refl", f.f32(0.0)).alias("sys_diff_refl"),
            F.coalesce("sys_diff_phase", f.f32(0.0)).alias("sys_diff_phase"),
            F.coalesce("first_elevation", "min_elevation", f.f32(EMPTY_ELEVATION)).alias("elevation_deg"),
            F.coalesce("available_tilts", F.array().cast("array<float>")).alias("available_tilts"),
        )
    )
