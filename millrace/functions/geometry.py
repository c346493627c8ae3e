"""Coordinates and extents as column arithmetic; rounding is half to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import fixed


def to_pixel(x: Column, size: Column, space: str) -> Column:
    """Pixel of a coordinate given in ``pixel``, in 0..1 (``unit``) or in 0..1000 (``thousand``)."""
    if space == "pixel":
        return F.rint(x).cast("long")
    share = x if space == "unit" else x / 1000
    return F.rint(share * F.greatest(size - 1, F.lit(0))).cast("long")


def to_thousand(x: Column, size: Column) -> Column:
    """0..1000 of a pixel, clamped; 0 when there is one pixel at most."""
    scaled = F.rint(x.cast("double") * 1000.0 / F.when(size > 1, size - 1)).cast("long")
    return F.coalesce(F.least(F.lit(1000), F.greatest(F.lit(0), scaled)), F.lit(0)).cast("long")


def scale(x: Column, old: Column, new: Column) -> Column:
    """Endpoint-preserving rescale: 0 stays 0 and old-1 becomes new-1."""
    return F.coalesce(F.rint(x * (new - 1) / F.when(old > 1, old - 1)).cast("long"), F.lit(0).cast("long"))


def scale_span(low: Column, high: Column, old: Column, new: Column) -> tuple[Column, Column]:
    """Both ends of an extent rescaled, one pixel wide at least."""
    a, b = scale(low, old, new), scale(high, old, new)
    return a, F.when(b <= a, F.least(a + 1, new - 1)).otherwise(b)


def resize(width: Column, height: Column, longest: Column | int) -> tuple[Column, Column]:
    """Size with the long side at most ``longest``; never larger than before."""
    limit = F.lit(longest) if isinstance(longest, int) else longest
    factor = limit / F.greatest(width, height)
    shrink = F.greatest(width, height) > limit
    side = lambda s: F.when(shrink, F.greatest(F.lit(1), F.rint(s * factor))).otherwise(s).cast("long")
    return side(width), side(height)


def long_side(width: Column, height: Column, target: Column, least: int = 11, usual: int = 1600, most: int = 1920) -> Column:
    """Resize limit that keeps the target's smaller extent at ``least`` pixels where possible."""
    longest = F.greatest(width, height)
    needed = F.ceil(least * longest / target)
    kept = (longest <= usual) | target.isNull() | (target <= 0) | (target * usual / longest >= least)
    return F.when(kept, usual).otherwise(F.least(F.greatest(F.lit(usual), needed), F.least(F.lit(most), longest))).cast("long")


def to_model(x: Column, width: Column, height: Column, longest: int = 1600) -> Column:
    """Uniform rescale of an observed coordinate to the model's view."""
    return F.rint(x * model_scale(width, height, longest)).cast("long")


def to_screen(x: Column, size: Column, width: Column, height: Column, longest: int = 1600) -> Column:
    """The way back from the model's view, clamped to the screen."""
    return F.least(F.greatest(F.rint(x / model_scale(width, height, longest)).cast("long"), F.lit(0)), size - 1).cast("long")


def model_scale(width: Column, height: Column, longest: int = 1600) -> Column:
    return F.when(F.greatest(width, height) <= longest, 1.0).otherwise(longest / F.greatest(width, height).cast("double"))


def inside(x: Column, y: Column, width: Column, height: Column) -> Column:
    return (x >= 0) & (x < width) & (y >= 0) & (y < height)


def valid_box(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    return (x1 >= 0) & (x1 < x2) & (x2 < width) & (y1 >= 0) & (y1 < y2) & (y2 < height)


def clamp(x: Column, low: Column, high: Column) -> Column:
    return F.greatest(low, F.least(x, high))


def size_bucket(width: Column, height: Column | None = None) -> Column:
    """Bucket of the smaller extent; of the width alone when no height is given."""
    extent = width if height is None else F.least(width, height)
    out = F.lit(list(fixed.SIZE_BUCKETS)[-1])
    for name, (low, high, _) in reversed(fixed.SIZE_BUCKETS.items()):
        out = F.when((extent >= low) & (extent < high), name).otherwise(out)
    return out


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def center_offset(x: Column, y: Column, left: Column, top: Column, right: Column, bottom: Column) -> Column:
    """Distance to a box's centre as a share of its diagonal; null outside the box."""
    diagonal = F.greatest(F.lit(1.0), F.sqrt(F.pow(right - left, F.lit(2)) + F.pow(bottom - top, F.lit(2))))
    distance = F.sqrt(F.pow(x - (left + right) / 2, F.lit(2)) + F.pow(y - (top + bottom) / 2, F.lit(2)))
    return F.when((x >= left) & (x <= right) & (y >= top) & (y <= bottom), F.round(distance / diagonal, 5))


def conversion_space(claimed_w: Column, claimed_h: Column, real_w: Column, real_h: Column, tolerance: float = 0.02) -> Column:
    """Which size coordinates refer to: ok, mismatch_used_actual or ambiguous."""
    claimed = claimed_w / F.when(claimed_h != 0, claimed_h)
    drift = F.abs(real_w / F.when(real_h != 0, real_h) - claimed) / claimed
    return F.when((claimed_w == real_w) & (claimed_h == real_h), "ok").when(drift <= tolerance, "mismatch_used_actual").otherwise("ambiguous")


def target_box(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column, spill: float = 25.0) -> Column:
    """Pixels (x1, y1, x2, y2) of a 0..1000 box that may spill over a little; null when invalid."""
    values = (x1, y1, x2, y2)
    near = F.least(*values) >= -spill
    near = near & (F.greatest(*values) <= 1000.0 + spill)
    kept = [clamp(v, F.lit(0.0), F.lit(1000.0)) for v in values]
    px = [to_pixel(v, s, "thousand") for v, s in zip(kept, (width, height, width, height))]
    box = F.struct(*[p.alias(n) for p, n in zip(px, ("x1", "y1", "x2", "y2"))])
    return F.when(near & valid_box(*px, width, height), box)


def png_size(content: Column) -> Column:
    """(width, height) in a PNG header; null for other content."""
    number = lambda at: F.conv(F.hex(F.substring(content, at, 4)), 16, 10).cast("long")
    return F.when(F.hex(F.substring(content, 1, 8)) == "89504E470D0A1A0A", F.struct(number(17).alias("width"), number(21).alias("height")))


def webp_size(content: Column) -> Column:
    """(width, height) in an extended WebP header; null for other content."""
    def number(at: int) -> Column:
        digits = [F.hex(F.substring(content, at + k, 1)) for k in (2, 1, 0)]
        return (F.conv(F.concat(*digits), 16, 10).cast("long") + 1)

    extended = (F.hex(F.substring(content, 13, 4)) == "56503858") & (F.length(content) >= 30)
    return F.when(extended, F.struct(number(25).alias("width"), number(28).alias("height")))
