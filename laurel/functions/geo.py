"""Distances and grid cells."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from laurel import fixed


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Great-circle metres; null when any coordinate is null."""
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlng = F.sin(F.radians(lng2 - lng1) / 2)
    a = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlng * half_dlng
    # least() skips nulls, so an unknown distance has to be put back
    return F.when(a.isNotNull(), 2 * F.lit(fixed.EARTH_RADIUS_M) * F.asin(F.least(F.lit(1.0), F.sqrt(a))))


METRES_PER_DEGREE = 111194.9  # a little under the true arc of one degree at EARTH_RADIUS_M


def lat_band(lat: Column, radius_m: float) -> Column:
    """Band number; two points within radius_m lie in the same or adjacent bands."""
    return F.floor(lat * METRES_PER_DEGREE / radius_m).cast("long")


def _lng_cells(band: Column, radius_m: float) -> Column:
    """How many equal cells one turn of longitude has in a band; each is at least radius_m wide."""
    size = radius_m / METRES_PER_DEGREE
    top = F.least(F.lit(90.0), (F.greatest(F.abs(band), F.abs(band + 1)) + 1) * size)
    width = F.lit(1.01 * size) / F.greatest(F.cos(F.radians(top)), F.lit(1e-3))
    return F.greatest(F.lit(1), F.floor(F.lit(360.0) / width)).cast("long")


def _lng_cell(lng: Column, band: Column, radius_m: float) -> Column:
    n = _lng_cells(band, radius_m)
    return F.pmod(F.floor((lng + 180.0) / 360.0 * n).cast("long"), n)


def home_cell(lat: Column, lng: Column, radius_m: float) -> Column:
    """(band, cell) of a point."""
    band = lat_band(lat, radius_m)
    return F.struct(band.alias("band"), _lng_cell(lng, band, radius_m).alias("cell"))


def nearby_cells(lat: Column, lng: Column, radius_m: float) -> Column:
    """At most 9 (band, cell) pairs that hold every point within radius_m."""
    bands = F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: lat_band(lat, radius_m) + d)

    def row(band):
        n, own = _lng_cells(band, radius_m), _lng_cell(lng, band, radius_m)
        return F.transform(
            F.array(F.lit(-1), F.lit(0), F.lit(1)),
            lambda d: F.struct(band.alias("band"), F.pmod(own + d, n).alias("cell")),
        )

    return F.array_distinct(F.flatten(F.transform(bands, row)))
