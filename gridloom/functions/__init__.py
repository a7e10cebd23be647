"""Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def decile(value: Column) -> Column:
    """A decile that ships as a double, as an integer; halves go to the even neighbour."""
    return F.bround(value).cast("int")


def millidegrees(key: Column) -> Column:
    """A coordinate key in thousandths of a degree; null for a malformed key."""
    return F.round(key.try_cast("double") * 1000).cast("int")


def lattice(key: Column) -> Column:
    """Row or column number of a cell key: centroids lie at (10 n + 5) thousandths."""
    return F.floor((millidegrees(key) - 5) / 10).cast("int")


def on_lattice(key: Column) -> Column:
    """Three decimals ending in 5."""
    return key.rlike(r"^-?\d+\.\d{3}$") & (F.abs(millidegrees(key)) % 10 == 5)


def is_territory(geo_id: Column, prefixes: tuple[str, ...]) -> Column:
    return F.substring(geo_id, 1, 2).isin(*prefixes)


def percent(part: Column, whole: Column) -> Column:
    """part of whole in percent; null without a positive whole."""
    return F.when(whole > 0, part / whole * 100)


def year_of_path(path: Column) -> Column:
    """The four-digit folder of a path as an integer."""
    return F.regexp_extract(path, r"/(?:year=)?(\d{4})/", 1).try_cast("int")


def pad_id(value: Column, width: int) -> Column:
    """A numeric id with leading zeros; longer ids stay whole."""
    text = value.cast("long").cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def default_measure(population: Column, above: float, raw: str, other: str) -> Column:
    """Raw counts suit populations above a threshold; smaller or unknown ones get the other measure."""
    return F.when(population > above, F.lit(raw)).otherwise(F.lit(other))


def albers(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Equal-area conic projection of the conterminous United States (GRS80; parallels 29.5 and 45.5, origin 23 N 96 W), in metres."""
    a, f = 6378137.0, 1 / 298.257222101
    e2 = f * (2 - f)
    e = math.sqrt(e2)
    sin = [math.sin(math.radians(x)) for x in (29.5, 45.5, 23.0)]
    m = [math.cos(math.radians(x)) / math.sqrt(1 - e2 * s * s) for x, s in zip((29.5, 45.5), sin)]
    area = lambda s: (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))
    q = [area(s) for s in sin]
    n = (m[0] ** 2 - m[1] ** 2) / (q[1] - q[0])
    c = m[0] ** 2 + n * q[0]
    rho0 = a * math.sqrt(c - n * q[2]) / n
    s = F.sin(F.radians(lat))
    qs = (1 - e2) * (s / (1 - e2 * s * s) - F.log((1 - e * s) / (1 + e * s)) / (2 * e))
    rho, theta = a * F.sqrt(c - n * qs) / n, F.radians(lon + 96.0) * n
    return rho * F.sin(theta), F.lit(rho0) - rho * F.cos(theta)
