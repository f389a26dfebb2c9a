"""Joins on where things lie: offsets in units of a stream, places near a point."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.geo import km as great_circle
from pageloom.operators import scan

EARTH_KM = 6371.0


def unit_of_offset(units: DataFrame, probes: DataFrame, doc: str, gap: int = 2) -> DataFrame:
    """probes with ``unit``: the first unit of the document whose text, or the ``gap`` behind it, holds the offset; of offsets that none holds the document's last unit.

    units: doc, unit, start, end (exclusive), in the order of start and unit.
    probes: doc, offset and any other columns. As the greatest end so far only
    grows, the first unit that ends behind an offset is the next one in the order
    of those ends; so units and offsets are merged in one sorted pass, whatever
    overlaps or is left out between them. A document without units has null.
    """
    placed = scan.scanned(units.select(doc, "unit", "start", "end"), doc, ["start", "unit"], _upto=scan.running_max(F.col("end")))
    mark = F.struct("unit", "start")
    none = lambda kind: F.lit(None).cast(kind)
    row = F.struct(*[F.col(c) for c in probes.columns])
    ends = placed.select(F.col(doc).alias("_doc"), (F.col("_upto") + gap).cast("long").alias("_at"), F.lit(0).alias("_kind"), F.struct(F.col("start").cast("long").alias("a"), F.col("unit").cast("string").alias("b")).alias("_tie"), mark.alias("_unit"), none(probes.select(row.alias("r")).schema["r"].dataType).alias("_row"))
    asks = probes.select(F.col(doc).alias("_doc"), F.col("offset").cast("long").alias("_at"), F.lit(1).alias("_kind"), F.struct(F.monotonically_increasing_id().alias("a"), F.lit("").alias("b")).alias("_tie"), none(ends.schema["_unit"].dataType).alias("_unit"), row.alias("_row"))
    merged = scan.scanned(ends.union(asks), "_doc", ["_at", "_kind", "_tie"], _next=scan.next_value(F.col("_unit"))).filter("_kind = 1")
    last = units.groupBy(F.col(doc).alias("_d")).agg(F.max_by("unit", F.struct("start", "unit")).alias("_last"))
    merged = merged.join(last, F.col("_doc").eqNullSafe(F.col("_d")), "left")
    inside = F.col("_next.start") <= F.col("_at")
    return merged.select("_row.*", F.when(inside, F.col("_next.unit")).otherwise(F.col("_last")).alias("unit"))


def _band(lat: Column, height: float) -> Column:
    return F.floor((lat + 90) / height)


def _cells(band: Column, height: float, reach: float) -> tuple[Column, Column]:
    """(number of cells around a band of latitude, degrees of longitude within reach of a point in it or a band beside it)."""
    far = F.greatest(F.abs(band * height - 90 - height), F.abs(band * height - 90 + 2 * height))
    ratio = F.when(far >= 90, 1.0).otherwise(F.lit(math.sin(reach / (2 * EARTH_KM))) / F.greatest(F.cos(F.radians(far)), F.lit(1e-12)))
    degrees = F.when(ratio >= 1, 360.0).otherwise(F.degrees(2 * F.asin(F.least(ratio, F.lit(1.0)))) * (1 + 1e-9))
    return F.greatest(F.floor(360 / degrees), F.lit(1)), degrees


def near_places(points: DataFrame, places: DataFrame, km: float) -> DataFrame:
    """point, place, km of every place within ``km`` of a point. points: point, lat, lon; places: place, lat, lon; nulls are near nothing.

    The globe is cut into bands of latitude as high as the distance, each into cells
    at least as wide as the distance spans there; a point meets the places of the
    cells that its distance can reach in its own band and the two beside it, around
    the date line and, next to the poles, all around. It is an equi-join on cells,
    so only places near a point meet it.
    """
    if not 0 < km <= 5000:
        raise ValueError("the distance must lie above 0 and not above 5000 km")
    height = math.degrees(km / EARTH_KM) * (1 + 1e-9)
    turned = lambda lon: F.pmod(lon + 180, F.lit(360.0))
    known = lambda f: f.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    n, _ = _cells(_band(F.col("lat"), height), height, km)
    held = known(places).select("place", F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), _band(F.col("lat"), height).alias("_band"), F.least(F.floor(turned(F.col("lon")) / 360 * n), n - 1).alias("_cell"))
    asked = known(points).select("point", "lat", "lon", F.explode(F.sequence(_band(F.col("lat"), height) - 1, _band(F.col("lat"), height) + 1)).alias("_band"))
    n, degrees = _cells(F.col("_band"), height, km)
    low, high = F.floor((turned(F.col("lon")) - degrees) / 360 * n), F.floor((turned(F.col("lon")) + degrees) / 360 * n)
    # all cells of the band at most, each once
    cells = F.array_distinct(F.transform(F.sequence(low, F.least(high, low + n - 1)), lambda c: F.pmod(c, n)))
    asked = asked.withColumn("_cell", F.explode(cells))
    met = asked.join(held, ["_band", "_cell"]).withColumn("km", great_circle(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")))
    return met.filter(F.col("km") <= km).select("point", "place", "km")
