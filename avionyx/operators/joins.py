"""Join helpers: broadcast only behind a proven size bound."""

from __future__ import annotations

import weakref

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import broadcast_limits

_FIXED_WIDTH = 16


def _width(field: T.StructField) -> Column:
    """Bytes of a column in a row, as an upper estimate."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + _FIXED_WIDTH
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + _FIXED_WIDTH
    return F.lit(_FIXED_WIDTH)


def measured_size(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes of ``df``: one aggregation, of which only the sums of
    each partition are moved."""
    width = F.lit(_FIXED_WIDTH)
    for field in df.schema.fields:
        width = width + _width(field)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("b")).first()
    return row["n"], row["b"] or 0


def bounded_broadcast(df: DataFrame, max_rows: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """``df`` hinted for broadcast if it has at most ``max_rows`` rows and
    ``max_bytes`` bytes, else ``df`` unchanged (Spark then plans a shuffle
    join, and AQE may still switch to a broadcast from runtime sizes).

    Call it on sources or materialized tables, not on an expensive lazy plan:
    the check reads ``df`` once.
    """
    rows, size = broadcast_limits(df.sparkSession)
    rows, size = rows if max_rows is None else max_rows, size if max_bytes is None else max_bytes
    if df not in _measured:
        _measured[df] = measured_size(df)
    n, b = _measured[df]
    return F.broadcast(df) if n <= rows and b <= size else df


# The size per DataFrame object, so that one frame used by several joins is
# measured once.
_measured: "weakref.WeakKeyDictionary[DataFrame, tuple[int, int]]" = weakref.WeakKeyDictionary()
