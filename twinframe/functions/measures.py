"""Hashes, distances, intervals and numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 63


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once for the row: inside another lambda a plain expression is computed for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def pack_hash(values: Column) -> Column:
    """63 low-frequency coefficients as bits of a long: bit i is set where value i exceeds their median (the 32nd of 63)."""

    def packed(median: Column) -> Column:
        bits = F.transform(values, lambda x, i: F.when(x > median, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
        return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))

    return let(F.element_at(F.sort_array(values), 32), packed)


def shares(values: Column) -> Column:
    """Absolute values as shares of their sum."""
    return let(total(F.transform(values, lambda x: F.abs(x))), lambda size: F.transform(values, lambda x: F.abs(x) / size))


def moments(x: Column, y: Column) -> Column:
    """Sums over two vectors in one pass: struct (x, y, xx, yy, xy)."""
    zero = F.struct(*(F.lit(0.0).alias(k) for k in ("x", "y", "xx", "yy", "xy")))

    def step(a: Column, p: Column) -> Column:
        u, v = p["u"], p["v"]
        return F.struct((a["x"] + u).alias("x"), (a["y"] + v).alias("y"), (a["xx"] + u * u).alias("xx"), (a["yy"] + v * v).alias("yy"), (a["xy"] + u * v).alias("xy"))

    return F.aggregate(F.arrays_zip(x.alias("u"), y.alias("v")), zero, step)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def hellinger(p: Column, q: Column) -> Column:
    """Bhattacharyya distance in its Hellinger form, of two histograms that sum to 1."""
    overlap = total(F.zip_with(p, q, lambda a, b: F.sqrt(F.greatest(a, F.lit(0.0))) * F.sqrt(F.greatest(b, F.lit(0.0)))))
    return F.sqrt(F.greatest(F.lit(0.0), F.lit(1.0) - overlap))


def log_aspect_gap(w1: Column, h1: Column, w2: Column, h2: Column) -> Column:
    """The distance of two aspect ratios' logarithms; null where a size is missing or not positive."""
    ratio = lambda w, h: F.greatest(F.lit(1e-8), F.when((w > 0) & (h > 0), w / h))
    known = (w1 > 0) & (h1 > 0) & (w2 > 0) & (h2 > 0)
    return F.when(known, F.abs(F.ln(ratio(w1, h1) / ratio(w2, h2))))


def pair_score(inliers: Column, matches: Column) -> Column:
    return inliers + 5.0 * inlier_ratio(inliers, matches)


def inlier_ratio(inliers: Column, matches: Column) -> Column:
    return inliers / F.greatest(F.lit(1), matches)


def correlation(x: Column, y: Column) -> Column:
    """Zero-mean normalised correlation of two vectors, clipped to [-1, 1]; 0 where their lengths differ."""
    n = F.size(x)

    def value(m: Column) -> Column:
        cov, vx, vy = m["xy"] - m["x"] * m["y"] / n, m["xx"] - m["x"] * m["x"] / n, m["yy"] - m["y"] * m["y"] / n
        return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cov / (F.sqrt(F.greatest(F.lit(0.0), vx * vy)) + 1e-12)))

    return F.when(F.size(x) == F.size(y), let(moments(x, y), value)).otherwise(F.lit(0.0))


def structural_similarity(x: Column, y: Column, span: float = 1.0) -> Column:
    """The structural similarity formula over one window that is the whole vector, clipped to [-1, 1]."""
    n, c1, c2 = F.size(x), (0.01 * span) ** 2, (0.03 * span) ** 2

    def value(m: Column) -> Column:
        mx, my = m["x"] / n, m["y"] / n
        vx, vy, cov = m["xx"] / n - mx * mx, m["yy"] / n - my * my, m["xy"] / n - mx * my
        return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), ((2 * mx * my + c1) * (2 * cov + c2)) / ((mx * mx + my * my + c1) * (vx + vy + c2))))

    return F.when(F.size(x) == F.size(y), let(moments(x, y), value)).otherwise(F.lit(0.0))


def wilson(successes: Column, total_: Column, z: float = 1.96) -> Column:
    """The Wilson score interval as a struct (low, high) within [0, 1]; (0, 0) where there are no trials."""
    n = total_.cast("double")
    p = successes / n
    scale = 1 + z * z / n
    centre = (p + z * z / (2 * n)) / scale
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / scale
    low, high = F.greatest(F.lit(0.0), centre - half), F.least(F.lit(1.0), centre + half)
    none = total_ <= 0
    return F.struct(F.when(none, 0.0).otherwise(low).alias("low"), F.when(none, 0.0).otherwise(high).alias("high"))


def number_or(text: Column, default: float = 0.0) -> Column:
    """A string as a double; the default where it is none."""
    return F.coalesce(text.try_cast("double"), F.lit(default))


def is_true(text: Column) -> Column:
    return F.coalesce(text.isin("1", "true", "True"), F.lit(False))


def letterbox(w: Column, h: Column, side: int, multiple: int = 16) -> Column:
    """Scale, size and padding of an image fitted to `side` and padded to a multiple: struct (scale, w, h, top, bottom, left, right)."""
    scale = F.lit(float(side)) / F.greatest(w, h)
    nw, nh = (F.greatest(F.lit(1), F.bround(x * scale).cast("int")) for x in (w, h))
    pad_w, pad_h = (F.pmod(F.lit(multiple) - x % multiple, F.lit(multiple)) for x in (nw, nh))
    top, left = F.floor(pad_h / 2).cast("int"), F.floor(pad_w / 2).cast("int")
    return F.struct(scale.alias("scale"), nw.alias("w"), nh.alias("h"), top.alias("top"), (pad_h - top).alias("bottom"), left.alias("left"), (pad_w - left).alias("right"))
