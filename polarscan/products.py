"""Radar products: names, moment codes, data-block names and value ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Product, moment code, data-block name prefix, lowest and highest quantized value.
PRODUCTS = [
    ("reflectivity", 1, "REF", -32.0, 94.5),
    ("velocity", 2, "VEL", -100.0, 100.0),
    ("spectrum_width", 3, "SW", 0.0, 64.0),
    ("differential_reflectivity", 4, "ZDR", -8.0, 8.0),
    ("differential_phase", 5, "PHI", 0.0, 360.0),
    ("correlation_coefficient", 6, "RHO", 0.0, 1.1),
]
ALIASES = {"cross_correlation_ratio": "correlation_coefficient"}
DEFAULT_PRODUCT = "reflectivity"
DEFAULT_RANGE_M = 230000.0

ALL_PRODUCTS = [p[0] for p in PRODUCTS]
_BY_NAME = {p[0]: p for p in PRODUCTS}


def canonical(product: str) -> str:
    """Resolve aliases; an unknown name behaves like reflectivity."""
    product = ALIASES.get(product, product)
    return product if product in _BY_NAME else DEFAULT_PRODUCT


def moment_code(product: str) -> int:
    return _BY_NAME[canonical(product)][1]


def block_prefix(product: str) -> str:
    return _BY_NAME[canonical(product)][2]


def value_range(product: str) -> tuple[float, float]:
    row = _BY_NAME[canonical(product)]
    return row[3], row[4]


def product_dim(spark: SparkSession, products: list[str] | None = None) -> DataFrame:
    """One row per requested product: (product, moment_code, block_prefix, value_min, value_max).

    An inline relation of at most a handful of rows, so Catalyst knows its size and broadcasts it by itself.
    """
    names = products if products is not None else ALL_PRODUCTS + sorted(ALIASES)
    rows = ", ".join(
        f"('{n}', {moment_code(n)}, '{block_prefix(n)}', "
        f"CAST({value_range(n)[0]} AS FLOAT), CAST({value_range(n)[1]} AS FLOAT))"
        for n in dict.fromkeys(names)
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(product, moment_code, block_prefix, value_min, value_max)")


def _case(product: Column, index: int) -> Column:
    default = F.lit(_BY_NAME[DEFAULT_PRODUCT][index])
    expr = None
    for name in ALL_PRODUCTS + sorted(ALIASES):
        value = F.lit(_BY_NAME[canonical(name)][index])
        expr = F.when(product == name, value) if expr is None else expr.when(product == name, value)
    return expr.otherwise(default)


def moment_code_of(product: Column) -> Column:
    return _case(product, 1).cast("int")


def block_prefix_of(product: Column) -> Column:
    return _case(product, 2)


def value_min_of(product: Column) -> Column:
    return _case(product, 3).cast("float")


def value_max_of(product: Column) -> Column:
    return _case(product, 4).cast("float")
