"""Result output: one JSON object per row (what a report endpoint returns)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def json_rows(df: DataFrame) -> DataFrame:
    """One ``value`` column holding each row as a JSON object (null fields kept).  Counts stay
    numbers; timestamps are ISO-8601 text in the session zone (UTC)."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false",
                                                        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"})
                     .alias("value"))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON-lines files, one object per row."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
