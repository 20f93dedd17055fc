"""Photo metadata: XMP text to typed columns, in one pass over the text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col

NUMBER = r"([+-]?[0-9]*\.?[0-9]+(?:[eE][+-]?[0-9]+)?)"
#: Tag names that cameras write, the misspelt one included.
LAT_TAGS = ("GpsLatitude", "Latitude")
LON_TAGS = ("GpsLongitude", "GpsLongtitude", "Longitude")
ALT_TAGS = ("AbsoluteAltitude", "GpsAltitude")
HEADING_TAGS = ("FlightYawDegree", "GimbalYawDegree")


def xmp_packet(content) -> Column:
    """The packet inside a file's bytes."""
    return F.regexp_extract(F.decode(col(content), "ISO-8859-1"), r"(?s)(<x:xmpmeta.*?</x:xmpmeta)", 1)


def xmp_number(xmp, *tags: str) -> Column:
    """First tag with a readable number; per tag the attribute form, then the element form."""
    tries = []
    for tag in tags:
        for pattern in (rf'{tag}="{NUMBER}"', rf">{NUMBER}</[A-Za-z-]*:?{tag}>"):
            tries.append(F.nullif(F.regexp_extract(col(xmp), pattern, 1), F.lit("")).try_cast("double"))
    return F.coalesce(*tries)


def xmp_dewarp(xmp) -> Column:
    """Nine numbers after the first semicolon of DewarpData as a struct; NULL with fewer."""
    names = ("fx", "fy", "cx", "cy", "k1", "k2", "p1", "p2", "k3")
    raw = F.regexp_extract(col(xmp), r'DewarpData="([^"]*)"', 1)
    parts = F.filter(F.split(F.regexp_replace(raw, "^[^;]*;", ""), "[, ]+"), lambda x: x != "")
    numbers = F.transform(parts, lambda x: x.try_cast("double"))
    ok = (F.size(numbers) >= 9) & ~F.exists(F.slice(numbers, 1, 9), lambda x: x.isNull())
    return F.when(ok, F.struct(*[F.get(numbers, F.lit(k)).alias(n) for k, n in enumerate(names)]))


def gps(xmp) -> Column:
    """Latitude, longitude and altitude; the altitude is never taken from an accuracy tag."""
    return F.struct(xmp_number(xmp, *LAT_TAGS).alias("lat"), xmp_number(xmp, *LON_TAGS).alias("lon"),
                    F.coalesce(xmp_number(xmp, *ALT_TAGS), F.lit(0.0)).alias("alt"))


def heading(xmp) -> Column:
    return xmp_number(xmp, *HEADING_TAGS)


def pitch(xmp) -> Column:
    """Gimbal pitch: about -90 looking down, -45 to -60 for obliques."""
    return xmp_number(xmp, "GimbalPitchDegree")


def is_oblique(pitch: Column, nadir: float = -80.0) -> Column:
    """No pitch counts as looking down."""
    return F.coalesce(pitch > nadir, F.lit(False))


def rtk(xmp) -> Column:
    return F.struct(xmp_number(xmp, "RtkStdLon").alias("lon"), xmp_number(xmp, "RtkStdLat").alias("lat"),
                    xmp_number(xmp, "RtkStdHgt").alias("hgt"), xmp_number(xmp, "RtkFlag").cast("int").alias("flag"))


def flight_key(path) -> Column:
    return F.element_at(F.split(col(path), "/"), -1)


def flight_time(name) -> Column:
    """Time inside a flight's name, 14 digits or 12; names sort by text all the same."""
    digits = F.regexp_extract(col(name), r"([0-9]{14}|[0-9]{12})", 1)
    return F.coalesce(F.try_to_timestamp(digits, F.lit("yyyyMMddHHmmss")), F.try_to_timestamp(digits, F.lit("yyyyMMddHHmm")))
