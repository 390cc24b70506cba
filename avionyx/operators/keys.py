"""Surrogate keys (D4) and idempotent dimension upserts.

Keys are dense integers in the order of the natural key.  A global
``row_number()`` over an unpartitioned window would pull the whole
dimension into one task, so numbering is done in three steps:

1. range-partition the members by the order columns, record each row's
   partition id as a column and materialize the result in the shared
   checkpoint folder (this fixes which row belongs to which range, so the
   two passes below agree, and survives executor loss);
2. count the rows of every partition: one row per partition, so the
   running offsets over it are computed on a frame whose size is bounded by
   the partition count, not by the data;
3. number rows inside each partition and add the partition's offset.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

MEMBERS_PER_RANGE = 1_000_000

_PART, _BEFORE = "_key_part", "_key_before"


def _cols(order_by: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def assign_surrogate_keys(
    members: DataFrame,
    order_by: Sequence[str | Column],
    key_col: str,
    start: int = 0,
    num_partitions: int | None = None,
) -> DataFrame:
    """Number ``members`` 1.., (plus ``start``) in ``order_by`` order, which
    must be a total order (the natural key).  The key comes first, as an int.
    The number of ranges, and so of files, follows the number of members.
    """
    if num_partitions is None:
        members = materialize(members, "members")
        num_partitions = max(1, -(-members.count() // MEMBERS_PER_RANGE))
    order = _cols(order_by)
    # The partition id is stored as a column, so the numbering below does not
    # depend on how the materialized table is split when read back.
    ranged = materialize(
        members.repartitionByRange(num_partitions, *order).withColumn(_PART, F.spark_partition_id()), "surrogate-keys"
    )

    sizes = ranged.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select(
        _PART,
        F.coalesce(
            F.sum("_n").over(Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias(_BEFORE),
    )
    # One row per partition: bounded by the partition count.
    numbered = ranged.join(F.broadcast(offsets), _PART).withColumn(
        key_col,
        (F.lit(start) + F.col(_BEFORE) + F.row_number().over(Window.partitionBy(_PART).orderBy(*order))).cast("int"),
    )
    rest = [c for c in members.columns if c != key_col]
    return numbered.select(key_col, *rest)


def new_members(existing: DataFrame, candidates: DataFrame, natural_key: Sequence[str]) -> DataFrame:
    """Candidates whose natural key is not in ``existing`` yet (one row per key)."""
    keys = list(natural_key)
    return candidates.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")


def ensure_dimension(
    existing: DataFrame,
    candidates: DataFrame,
    natural_key: Sequence[str],
    key_col: str,
    order_by: Sequence[str | Column] | None = None,
) -> DataFrame:
    """The rows to append so that every candidate's natural key is in
    the dimension.  Existing keys are kept; new members get max(key)+1.. in
    ``order_by`` order (natural key order by default).  Running it again
    with the same candidates returns no rows.
    """
    fresh = new_members(existing, candidates, natural_key)
    top = existing.agg(F.max(key_col).alias("m")).first()["m"] or 0  # one scalar
    cols = [key_col] + [c for c in existing.columns if c != key_col]
    keyed = assign_surrogate_keys(fresh, order_by or list(natural_key), key_col, start=int(top))
    types = {f.name: f.dataType for f in existing.schema.fields}
    return keyed.select(
        *[F.col(c).cast(types[c]) if c in keyed.columns else F.lit(None).cast(types[c]).alias(c) for c in cols]
    )
