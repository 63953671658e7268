"""Column functions that the SQL dialects do not share."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Fixed value: the name space of URLs for version 5 identifiers.
URL_SPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: Column) -> Column:
    """Version 5 identifier of a name in the URL space."""
    digest = F.sha1(F.concat(F.unhex(F.lit(URL_SPACE)), name.cast("binary")))
    variant = F.element_at(F.split(F.lit("8 9 a b"), " "), (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1))
    return F.concat_ws(
        "-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12),
    )


def tree_id(source: Column, srid: int, x: Column, y: Column) -> Column:
    """Identifier of a detection by its source, reference system and place."""
    return uuid5(F.format_string("%s|%d|%.6f|%.6f", source, F.lit(srid), x, y))


def seed_for(*parts: Column) -> Column:
    """63-bit seed of the parts: eight digest bytes, lowest first, halved."""
    digest = F.sha2(F.concat_ws("|", *parts), 256)
    swapped = F.concat(*[F.substring(digest, 1 + 2 * i, 2) for i in range(7, -1, -1)])
    high = F.conv(F.substring(swapped, 1, 8), 16, 10).cast("long")
    low = F.conv(F.substring(swapped, 9, 8), 16, 10).cast("long")
    return high * F.lit(1 << 31) + F.shiftright(low, 1)


def lab_to_hex(lightness: Column, a: Column, b: Column) -> Column:
    """CIELAB (D65) to an sRGB hex colour, clamped."""
    fy = (lightness + 16) / 116
    cube = lambda t: F.when(t > 6 / 29, t * t * t).otherwise(3 * (6 / 29) ** 2 * (t - 4 / 29))
    x, y, z = 0.95047 * cube(fy + a / 500), cube(fy), 1.08883 * cube(fy - b / 200)
    linear = (3.2406 * x - 1.5372 * y - 0.4986 * z, -0.9689 * x + 1.8758 * y + 0.0415 * z, 0.0557 * x - 0.2040 * y + 1.0570 * z)
    gamma = lambda c: F.when(c <= 0.0031308, 12.92 * c).otherwise(1.055 * F.pow(F.greatest(c, F.lit(0.0)), 1 / 2.4) - 0.055)
    byte = lambda c: F.round(F.least(F.greatest(gamma(c), F.lit(0.0)), F.lit(1.0)) * 255).cast("int")
    return F.format_string("#%02x%02x%02x", *[byte(c) for c in linear])


def wilson(successes: Column, n: Column, z: float = 1.959963984540054) -> Column:
    """Wilson score interval (low, high); null without observations."""
    p, zz = successes / n, z * z
    half = z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))
    low, high = ((p + zz / (2 * n) + s * half) / (1 + zz / n) for s in (-1, 1))
    low, high = F.greatest(low, F.lit(0.0)), F.least(high, F.lit(1.0))
    return F.when(n > 0, F.struct(low.alias("low"), high.alias("high")))
