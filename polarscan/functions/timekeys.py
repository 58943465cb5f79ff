"""Object keys, timestamps and file names. Date parts never depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86400000
VOLUME_FILE = "volumetric.RDA"


def julian_to_key(julian_day: Column, ms: Column) -> Column:
    """``yyyyMMdd_HHmmss`` from a 1-based day count (1970-01-01 is day 1) and milliseconds of the day."""
    total = (julian_day.cast("bigint") - F.lit(1)) * F.lit(DAY_MS) + ms.cast("bigint")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(total / F.lit(DAY_MS)).cast("int"))
    second = F.floor(F.pmod(total, F.lit(DAY_MS)) / F.lit(1000)).cast("int")
    return F.concat(F.date_format(day, "yyyyMMdd"), F.lit("_"), clock(second))


def clock(second_of_day: Column, sep: str = "") -> Column:
    s = second_of_day.cast("int")
    parts = [F.floor(s / 3600), F.floor(s / 60) % 60, s % 60]
    return F.concat_ws(sep, *[F.lpad(p.cast("int").cast("string"), 2, "0") for p in parts])


def day_number(date: Column) -> Column:
    """1-based day count of a date."""
    return F.datediff(date, F.lit("1970-01-01").cast("date")) + F.lit(1)


def key_to_timestamp(key: Column) -> Column:
    return F.to_timestamp(key, "yyyyMMdd_HHmmss")


def file_name(object_key: Column) -> Column:
    return F.substring_index(object_key, "/", -1)


def object_timestamp(object_key: Column) -> Column:
    """Date from characters 5-12 of the file name, time from the six characters behind its first underscore."""
    name = file_name(object_key)
    after = F.substring(name, F.instr(name, "_") + F.lit(1), F.lit(6))
    return F.concat(F.substring(name, 5, 8), F.lit("_"), after)


def object_station(object_key: Column) -> Column:
    """Station folder of ``yyyy/MM/dd/STATION/file``."""
    return F.regexp_extract(object_key, r"(?:^|/)\d{4}/\d{2}/\d{2}/([^/]+)/", 1)


def is_volume_key(object_key: Column) -> Column:
    name = file_name(object_key)
    return ~F.contains(name, F.lit("_MDM")) & (F.length(name) >= 20)


def day_prefix(date: Column, station: Column | None = None) -> Column:
    day = F.date_format(date, "yyyy/MM/dd")
    return F.concat(day, F.lit("/")) if station is None else F.concat(day, F.lit("/"), station, F.lit("/"))


def tilt_file(tilt: Column) -> Column:
    # Ties go to the even digit, unlike format_string's own rounding.
    return F.format_string("%.1f.RDA", F.rint(tilt.cast("double") * F.lit(10.0)) / F.lit(10.0))


def file_tilt(filename: Column) -> Column:
    """Tilt in a file name; the volume file and anything unreadable count as 0."""
    return F.coalesce(F.regexp_extract(filename, r"^(-?[0-9]+(?:\.[0-9]+)?)\.RDA", 1).try_cast("float"), F.lit(0.0)).cast("float")


def human_size(n: Column) -> Column:
    def text(power: int, unit: str) -> Column:
        hundredths = F.rint(n.cast("double") * F.lit(100.0) / F.lit(float(1024**power)))
        return F.format_string(f"%.2f {unit}", hundredths / F.lit(100.0))

    return (
        F.when(n < 1024, text(0, "B"))
        .when(n < 1024**2, text(1, "KB"))
        .when(n < 1024**3, text(2, "MB"))
        .when(n < 1024**4, text(3, "GB"))
        .otherwise(text(4, "TB"))
    )


def clock_from_ns(ns: Column) -> Column:
    second = F.pmod(F.floor(ns / F.lit(1000000000)), F.lit(86400))
    return F.when(ns == 0, F.lit("N/A")).otherwise(F.concat(clock(second, ":"), F.lit(" UTC")))


def success_rate(fetched: Column, failed: Column) -> Column:
    return F.coalesce(F.try_divide(fetched.cast("double"), (fetched + failed).cast("double")) * F.lit(100.0), F.lit(0.0))


def per_minute(fetched: Column, uptime_seconds: Column) -> Column:
    return F.coalesce(F.try_divide(fetched.cast("double"), uptime_seconds.cast("double")) * F.lit(60.0), F.lit(0.0))
