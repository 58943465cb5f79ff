"""Moments to products and bins."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import products as pr
from .. import schemas

BELOW_THRESHOLD_OR_FOLDED = 1
RADIALS_AT_ONCE = 64


def block_code(name: Column) -> Column:
    """Moment code of a data-block name by its prefix; null for other names."""
    expr = None
    for _, code, prefix, _, _ in pr.PRODUCTS:
        hit = F.startswith(name, F.lit(prefix))
        expr = F.when(hit, F.lit(code)) if expr is None else expr.when(hit, F.lit(code))
    return expr


def for_products(moments: DataFrame, products: list[str]) -> DataFrame:
    """Pairs each moment with every requested product of its code; other moments drop out."""
    dim = pr.product_dim(moments.sparkSession, products)
    # The dimension is an inline relation with one row per requested product.
    return moments.withColumn("moment_code", block_code(F.col("name"))).join(F.broadcast(dim), "moment_code")


def decode_gates(packed: bytes, num_gates: int, word_size: int) -> np.ndarray:
    return np.frombuffer(packed, dtype=">u2" if word_size == 16 else "u1", count=num_gates)


@lru_cache(maxsize=128)
def value_table(word_size: int, offset: float, scale: float, floor_at: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Calibrated value, rounded to tenths, and "carries data" for every raw code (float32 throughout).

    Raw codes have 8 or 16 bits and a volume uses few scales, so gates are decoded by table lookup.
    """
    raw = np.arange(1 << word_size)
    with np.errstate(all="ignore"):
        value = (raw.astype("f4") - np.float32(offset)) / np.float32(scale)
        keep = raw > BELOW_THRESHOLD_OR_FOLDED
        if floor_at is not None:
            keep &= ~(value < np.float32(floor_at))
        tenths = (value * np.float32(10.0)).astype("f8")
        value = np.copysign(np.floor(np.abs(tenths) + 0.5), tenths).astype("f4") * np.float32(0.1)
    return value, keep


def gate_ranges(gates: np.ndarray, first_gate: float, spacing: float) -> np.ndarray:
    return np.float32(first_gate) + gates.astype("f4") * np.float32(spacing)


_IN = ["volume_id", "product", "sweep_id", "msg_seq", "azimuth", "moment_code", "num_gates", "word_size", "first_gate"] + [
    "gate_spacing",
    "offset",
    "scale",
    "gates",
]
_OUT = ["volume_id", "product", "sweep_id", "msg_seq", "gate", "azimuth", "range_m", "value"]


def explode_bins(moments: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per gate with data, with the ``carried`` columns of its radial. Gates never pass through Python objects one by
    one, and a batch that leaves holds the bins of at most ``RADIALS_AT_ONCE`` radials, whatever the size of those that arrive."""
    same = ("volume_id", "product", "sweep_id", "msg_seq", "azimuth", *carried)
    names = [*_OUT, *carried]

    def run(batches):
        for batch in (b.slice(at, RADIALS_AT_ONCE) for b in batches for at in range(0, b.num_rows, RADIALS_AT_ONCE)):
            cols = batch.select(_IN).to_pydict()
            counts, gate, range_m, value = [], [], [], []
            for i in range(batch.num_rows):
                raw = decode_gates(cols["gates"][i], cols["num_gates"][i], cols["word_size"][i])
                floor_at = -32.0 if cols["moment_code"][i] == 1 else None
                table, carries = value_table(cols["word_size"][i], cols["offset"][i], cols["scale"][i], floor_at)
                g = np.flatnonzero(carries[raw])
                counts.append(len(g))
                gate.append(g.astype("i4"))
                value.append(table[raw[g]])
                range_m.append(gate_ranges(g, cols["first_gate"][i], cols["gate_spacing"][i]))
            if not sum(counts):
                continue
            rows = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            out = {n: batch.column(n).take(rows) for n in same}
            out["gate"], out["range_m"], out["value"] = map(np.concatenate, (gate, range_m, value))
            yield pa.RecordBatch.from_arrays([pa.array(out[n]) for n in names], names=names)

    kinds = dict(moments.dtypes)
    return moments.select(*_IN, *carried).mapInArrow(run, ", ".join([schemas.BINS, *(f"{c} {kinds[c]}" for c in carried)]))
