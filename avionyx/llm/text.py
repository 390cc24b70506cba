"""Helpers shared by the text operators: words, bounded batches, appended columns."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER_AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SLICE_CHARS = 2_000_000


def lower_az(text: str) -> str:
    """Lower-case A-Z only; other letters stay."""
    return text.lower() if text.isascii() else text.translate(LOWER_AZ)


def slices(texts: list[str | None], limit: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts together hold about ``limit`` characters.

    A longer text is a range of its own, so a task holds the working arrays
    of one slice only.
    """
    start, held = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


Batches = Iterator[pa.RecordBatch]


def give_back() -> None:
    """Return memory that was freed to the system: Arrow's pool and the C heap keep it for the process otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        trim = ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # not glibc
        return
    trim(0)


def giving_back(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, which gives back freed memory at the end of each task.

    A Python worker goes on to the tasks of later stages, beside what it kept.
    """

    @wraps(run)
    def task(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores appended while a column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def append_column(
    df: DataFrame,
    text_col: str,
    name: str,
    kind: T.DataType,
    make: Callable[[list[str | None]], list],
    done: Callable[[], None] | None = None,
) -> DataFrame:
    """``df`` with one more column, computed from the texts of bounded slices.

    All other columns pass through the Arrow batches untouched, so rows need
    no key and repeated rows stay repeated.  ``done`` is called at the end of
    every task.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(name, kind)])
    at = df.columns.index(text_col)
    arrow_kind = to_arrow_type(kind)

    @giving_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            made: list = []
            for lo, hi in slices(texts):
                made += make(texts[lo:hi])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(made, arrow_kind)], names=[*batch.schema.names, name]
            )
        if done is not None:
            done()

    return df.mapInArrow(run, schema)
