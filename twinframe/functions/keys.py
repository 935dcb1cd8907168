"""Keys, names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slashes(path: Column) -> Column:
    return F.replace(path, F.lit("\\"), F.lit("/"))


def normal_key(key: Column) -> Column:
    """A key without surrounding blanks, a track prefix (low| or high|) or backslashes."""
    return F.regexp_replace(slashes(F.trim(key)), r"^(low|high)\|", "")


def first_alias(*names: Column) -> Column:
    """The first of several alias columns that is not empty."""
    return F.coalesce(*(F.nullif(n, F.lit("")) for n in names))


def bin_leaf(source: Column) -> Column:
    """The leaf name, without extension, of a BinData entry; null for other sources."""
    leaf = F.regexp_replace(F.regexp_extract(source, r"(?i)BinData[\\/]([^\\/]+)", 1), r"\.[^.]*$", "")
    return F.nullif(leaf, F.lit(""))


def relative_to(path: Column, root: Column) -> Column:
    """path relative to root, or its base name where it lies elsewhere."""
    inside = F.concat(F.rtrim(slashes(root), F.lit("/")), F.lit("/"))
    own = slashes(path)
    return F.when(F.startswith(own, inside), F.substring(own, F.length(inside) + 1, F.length(own))).otherwise(base_name(own))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(slashes(path), "/"), -1)


def looks_like_preview(name: Column) -> Column:
    """Names of thumbnails and previews."""
    return F.lower(name).rlike("preview|thumb|prv|_pv_")


def is_markup_or_font(name: Column) -> Column:
    return F.lower(name).rlike(r"\.(xml|rels|ttf|otf)$")


def is_image_file(path: Column) -> Column:
    return F.lower(path).rlike(r"\.(png|jpg|jpeg|bmp|gif|tif|tiff|webp)$")


def in_bin_folder(path: Column) -> Column:
    """Streams two levels deep or more whose first folder is BinData in any case."""
    parts = F.split(slashes(path), "/")
    return (F.size(parts) >= 2) & (F.lower(F.element_at(parts, 1)) == "bindata")
