"""Volumes to radials, sweeps, moments, frames, bins and packed files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import products as pr
from ..operators import framing, metadata, moments, points, radials, raster
from ..session import materialize
from ..sources import rda


@dataclass(frozen=True)
class Decoded:
    """Tables of one decode. All are lazy views on the one written block table, so columns not asked for are not read."""

    radials: DataFrame
    sweeps: DataFrame
    moments: DataFrame
    frames: DataFrame
    ranges: DataFrame

    def bins(self) -> DataFrame:
        """One row per gate with data."""
        return moments.explode_bins(self.moments)

    def point_bins(self) -> DataFrame:
        """One row per gate with data, with its sweep's elevation and its site's height."""
        return moments.explode_bins(points.sited(self.moments, self.sweeps, self.frames), ("elevation_deg", "height_asl"))

    def tilt_rays(self) -> DataFrame:
        return metadata.tilt_ray_counts(self.sweeps)

    def tilts(self, profile: raster.RasterProfile = raster.INGEST) -> DataFrame:
        return raster.tilt_table(self.frames, self.tilt_rays(), profile)

    def cuts(self, profile: raster.RasterProfile = raster.INGEST) -> DataFrame:
        return raster.cuts(self.sweeps, self.tilts(profile), profile)

    def cut_bins(self, profile: raster.RasterProfile = raster.INGEST) -> DataFrame:
        """One row per gate with data and tilt that it feeds."""
        return raster.cut_bins(self.moments, self.cuts(profile))

    def tilt_packs(self, profile: raster.RasterProfile = raster.INGEST, slabs: bool = True) -> DataFrame:
        return raster.pack_tilts(self.moments, self.cuts(profile), profile, slabs=slabs)


def decode(
    volumes: DataFrame,
    products: list[str] | None = None,
    strict: bool = False,
    low_byte_word_size: bool = False,
    write_radials: bool = True,
    gates: bool = True,
) -> Decoded:
    """Decodes all requested products in one pass over the volumes.

    The Python generator runs once: its blocks are written to a table in the shared folder, and sweeps, metadata and
    moments read the columns they need from there. Moments of other products are never written, and ``gates=False`` writes
    no gates at all, for callers that want sweeps and metadata. ``write_radials=False`` keeps everything lazy.
    """
    products = list(dict.fromkeys(products or pr.ALL_PRODUCTS))
    codes = sorted({pr.moment_code(p) for p in products})
    rows = radials.block_rows(volumes, codes, gates, strict)
    if write_radials:
        rows = materialize(rows, "blocks")
    heads = rows.where(F.col("msg_type") == 0).select("volume_id", "head").join(framing.hints(volumes), "volume_id")
    segmented = radials.radials_of(rows)
    sweep_rows = metadata.sweeps(segmented)
    if write_radials:
        # A few dozen rows per volume that nearly every later step joins with.
        sweep_rows = materialize(sweep_rows, "sweeps")
    sites, ranges = radials.site_blocks(rows), radials.range_blocks(rows)
    moment_rows = moments.for_products(radials.moment_blocks(rows, low_byte_word_size), products)
    # Legacy radials carry reflectivity only, whatever the requested products' names start with.
    moment_rows = moment_rows.where((F.col("msg_type") == 31) | (F.col("moment_code") == 1))
    geometry = metadata.first_geometry(moment_rows, ["volume_id", "product"])
    frame_rows = metadata.frames(
        framing.header_fields(heads), products, segmented, sweep_rows, sites, ranges, geometry
    )
    if write_radials:
        frame_rows = materialize(frame_rows, "frames")
    return Decoded(segmented, sweep_rows, moment_rows, frame_rows, ranges)


def frame_files(
    decoded: Decoded,
    profile: raster.RasterProfile = raster.INGEST,
    save_tilts: bool = True,
    save_volumes: bool = True,
    identity: DataFrame | None = None,
) -> DataFrame:
    """File rows of all tilts and volumes. Packs are written once and feed both.

    ``identity`` (volume_id, station, timestamp) names the files by object key instead of by volume header.
    """
    frames = decoded.frames
    if identity is not None:
        frames = frames.drop("station", "timestamp").join(identity, "volume_id")
    packs = materialize(decoded.tilt_packs(profile, slabs=save_volumes), "packs")
    parts = []
    if save_tilts:
        parts.append(rda.tilt_files(packs, frames))
    if save_volumes:
        parts.append(rda.volume_files(raster.volume_packs(packs), frames))
    if not parts:
        raise ValueError("nothing to save: both tilts and volumes are switched off")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


OFFLINE_STATION, OFFLINE_TIMESTAMP = "TEST", "20260215_000000"


def offline_files(volumes: DataFrame) -> DataFrame:
    """Single-file conversion: reflectivity only, the offline dialect, and a fixed identity in the output."""
    decoded = decode(volumes, ["reflectivity"])
    rows = frame_files(decoded, raster.OFFLINE)
    return rows.withColumn("station", F.lit(OFFLINE_STATION)).withColumn("timestamp", F.lit(OFFLINE_TIMESTAMP))
