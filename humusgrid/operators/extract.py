"""Extraction from text with positions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Latitude and longitude in degrees, minutes and perhaps seconds.
LATITUDE = r"(\d{1,2})\s*[°º]\s*(\d{1,2})\s*[′'](?:\s*(\d{1,2})\s*[″\"]\s*)?\s*([NSns])"
LONGITUDE = r"(\d{1,3})\s*[°º]\s*(\d{1,2})\s*[′'](?:\s*(\d{1,2})\s*[″\"]\s*)?\s*([EWew])"


def find_all(df: DataFrame, id_col: str, text_col: str, pattern: str, start: int = 0, end: int | None = None) -> DataFrame:
    """(id_col, position, groups) of every match, positions counted from the window's start."""
    schema = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, position int, groups array<string>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compiled = re.compile(pattern)
        for batch in batches:
            rows = [(key, m.start(), list(m.groups())) for key, text in zip(batch[id_col], batch[text_col]) if isinstance(text, str) for m in compiled.finditer(text[start:end])]
            yield pd.DataFrame(rows, columns=[id_col, "position", "groups"])

    return df.select(id_col, text_col).mapInPandas(run, schema)


def decimal_degrees(groups: Column, most: int, negative: str) -> Column:
    """Decimal degrees of (degrees, minutes, seconds, hemisphere); null out of range."""
    d, m, s = (F.coalesce(groups[i].try_cast("double"), F.lit(0.0)) for i in range(3))
    value = d + m / 60 + s / 3600
    return F.when((d <= most) & (m <= 59) & (s <= 59), F.when(F.upper(groups[3]) == negative, -value).otherwise(value))


def dms_coordinates(df: DataFrame, id_col: str, text_col: str, start: int = 1200, end: int | None = None, within: int = 200) -> DataFrame:
    """(id_col, latitude, longitude, position): each latitude with the first longitude less than `within` characters after it."""
    lat = find_all(df, id_col, text_col, LATITUDE, start, end).select(id_col, "position", decimal_degrees(F.col("groups"), 90, "S").alias("latitude")).filter("latitude is not null")
    lon = find_all(df, id_col, text_col, LONGITUDE, start, end).select(id_col, F.col("position").alias("lon_at"), decimal_degrees(F.col("groups"), 180, "W").alias("longitude")).filter("longitude is not null")
    near = lat.join(lon, id_col).filter((F.col("lon_at") > F.col("position")) & (F.col("lon_at") < F.col("position") + within))
    return near.groupBy(id_col, "position", "latitude").agg(F.min_by("longitude", "lon_at").alias("longitude")).select(id_col, "latitude", "longitude", "position")
