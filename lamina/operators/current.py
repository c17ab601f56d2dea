"""Current, not deleted rows of the project tables, with all their columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import current_rows


def current(df: DataFrame, keys: tuple[str, ...] = ("id",), order: str = "loaded_at", deleted: str = "is_deleted", only: tuple[str, ...] | None = None) -> DataFrame:
    """The version with the greatest ``order`` of each key, without tombstones. ``order`` and ``deleted`` are dropped.

    ``only``: the columns wanted beside the keys, so that no other is read and shuffled (an aggregation over whole rows is not pruned).
    """
    cols = [c for c in df.columns if c not in (*keys, order) and (only is None or c in only or c == deleted)]
    rows = current_rows(df, list(keys), {c: c for c in cols}, order)
    if deleted in cols:
        rows = rows.where(~F.coalesce(F.col(deleted), F.lit(False)))
    return rows.select(*[c for c in df.columns if c in (*keys, *cols) and c not in (order, deleted)])
