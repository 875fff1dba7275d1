"""Path columns: names, suffixes, padded numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def dirname(path: Column) -> Column:
    """All before the last slash; empty without one."""
    return F.regexp_extract(path, r"^(?s)(.*)/[^/]*$", 1)


def join_path(*parts: Column) -> Column:
    return F.concat_ws("/", *parts)


def strip_extension(path: Column) -> Column:
    """Without the last extension of the last name; a leading dot starts no extension."""
    return F.regexp_replace(path, r"(?<=[^/.])\.[^./]*$", "")


def swap_suffix(path: Column, old: str, new: str) -> Column:
    """Replaces every occurrence of `old`, wherever it stands, as the naming convention of siblings does."""
    return F.replace(path, F.lit(old), F.lit(new))


def depth_image_path(path: Column) -> Column:
    return F.concat(strip_extension(path), F.lit(".depth.jpg"))


def has_suffix(path: Column, suffix: str, any_case: bool = False) -> Column:
    return F.lower(path).endswith(suffix.lower()) if any_case else path.endswith(suffix)


def is_depth_image(path: Column) -> Column:
    return F.lower(path).endswith(".depth.jpg")


def padded(number: Column, width: int) -> Column:
    """At least `width` digits; longer numbers are kept whole."""
    return F.format_string(f"%0{width}d", number)
