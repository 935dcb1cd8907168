"""Image types by their leading bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leading bytes (hex), extension, media type, in the order in which they are tried.
SIGNATURES = (
    ("FFD8FF", "jpg", "image/jpeg"),
    ("89504E470D0A1A0A", "png", "image/png"),
    ("474946383761", "gif", "image/gif"),
    ("474946383961", "gif", "image/gif"),
    ("424D", "bmp", "image/bmp"),
    ("49492A00", "tif", "image/tiff"),
    ("4D4D002A", "tif", "image/tiff"),
    ("00000100", "ico", "image/x-icon"),
    ("D7CDC69A", "wmf", "image/wmf"),
    ("01000000", "emf", "image/emf"),
)
VECTOR = ("wmf", "emf")


def _is(content: Column, prefix: str, at: int = 1) -> Column:
    return F.substring(content, at, len(prefix) // 2) == F.unhex(F.lit(prefix))


def _chosen(content: Column, value: int, include_vector: bool) -> Column:
    riff = _is(content, "52494646") & _is(content, "57454250", 9)
    out = F.when(riff, F.lit(("webp", "image/webp")[value]))
    for prefix, *names in SIGNATURES:
        if include_vector or names[0] not in VECTOR:
            out = out.when(_is(content, prefix), F.lit(names[value]))
    return out


def image_ext(content: Column, include_vector: bool = True) -> Column:
    """The extension of a recognised type; null otherwise. RIFF counts only as WEBP."""
    return _chosen(content, 0, include_vector)


def image_mime(content: Column, include_vector: bool = True) -> Column:
    return _chosen(content, 1, include_vector)


def encoder_format(ext: Column, fallback: Column | None = None) -> Column:
    """The encoder's name for an extension: known ones by table, else the fallback's in capitals, else JPEG; tif is TIFF."""
    known = F.create_map(*(F.lit(x) for pair in (("jpg", "JPEG"), ("jpeg", "JPEG"), ("png", "PNG"), ("bmp", "BMP"), ("webp", "WEBP")) for x in pair))
    other = F.upper(F.ltrim(fallback, F.lit("."))) if fallback is not None else F.lit(None).cast("string")
    other = F.when(other == "JPG", "JPEG").when(other == "TIF", "TIFF").otherwise(F.nullif(other, F.lit("")))
    return F.coalesce(known[F.coalesce(F.lower(ext), F.lit(""))], other, F.lit("JPEG"))
