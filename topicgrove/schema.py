"""Table schemas, column names and column guards."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_RENDERED = T.StructType([T.StructField("rendered", T.StringType())])

RAW_POST = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("date", T.StringType()),
        T.StructField("link", T.StringType()),
        T.StructField("title", _RENDERED),
        T.StructField("content", _RENDERED),
    ]
)

POST_COLUMNS = ["text", "title", "url", "date", "id"]
EMBED_COLUMNS = ["text", "title"]
NAMING_COLUMNS = ["text", "title", "url"]


def cluster_column(level: int) -> str:
    return f"topic_level_{level}_cluster_id"


def tag_column(level: int) -> str:
    return f"topic_level_{level}"


def cluster_columns(num_levels: int) -> list[str]:
    """Cluster id columns, level 1 (coarsest) first."""
    return [cluster_column(level) for level in range(1, num_levels + 1)]


def tag_columns(num_levels: int) -> list[str]:
    return [tag_column(level) for level in range(1, num_levels + 1)]


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Raise ValueError with all columns that are not there; runs no job."""
    absent = sorted(set(required) - set(df.columns))
    if absent:
        raise ValueError(f"The table lacks {', '.join(absent)}; it has {', '.join(df.columns)}.")
    return df


def require_levels(df: DataFrame, num_levels: int) -> DataFrame:
    return require_columns(df, NAMING_COLUMNS + cluster_columns(num_levels))


def validate_distances(distances: Sequence[float]) -> list[float]:
    """Cut distances as floats: one or more positive numbers, each smaller than the one before.

    The order makes level 1 the coarsest and keeps the levels nested, so that every cluster has exactly one parent. Ward
    heights grow with the number of points, so there is no upper bound.
    """
    cuts = [float(d) for d in distances]
    steps = zip([math.inf, *cuts], cuts)
    if not cuts or not all(0 < now < before for before, now in steps):
        raise ValueError(f"Cuts need falling positive distances, got {distances!r}.")
    return cuts
