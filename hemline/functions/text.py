"""Series ids and file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the last two segments of a path.
LAST_TWO_SEGMENTS = r"[\/]([^\/]+[\/][^\/]+)$"

# Fixed value: the columns that make up a series id, in order.
SERIES_ID_PARTS = [
    "external_code",
    "retail",
    "season",
    "category",
    "color",
    "fabric",
    "release_date",
]


def series_id(parts: list[str] | None = None) -> Column:
    """Parts joined without a separator; NULL when any part is NULL.

    Kept for equal ids. Two different part lists can give the same text, so joins inside the library
    use the columns and not this id.
    """
    return F.concat(*[F.col(p).cast("string") for p in parts or SERIES_ID_PARTS])


def folder_and_file(path: Column | str) -> Column:
    return F.regexp_extract(F.col(path) if isinstance(path, str) else path, LAST_TWO_SEGMENTS, 1)


def path_category(path: Column | str) -> Column:
    return F.get(F.split(folder_and_file(path), "/"), F.lit(0))


def path_file_name(path: Column | str) -> Column:
    return F.get(F.split(folder_and_file(path), "/"), F.lit(1))


def image_path(category: str = "category", file_name: str = "file_name") -> Column:
    return F.concat(F.col(category), F.lit("/"), F.col(file_name))
