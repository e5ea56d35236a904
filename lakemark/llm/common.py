"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import gc
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemark.session import stored

__all__ = ["broadcast_if_small", "packed", "quoted", "stored", "table", "text_slices", "unpacked", "worker_state"]

# A side is broadcast only after its rows were counted and measured.
BROADCAST_BYTES = 8 << 20
# Texts handled together inside a task; a batch is never larger than that or one text.
SLICE_CHARS = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows it, else as it is.

    ``df`` should be a stored table: it is read once to be measured.
    """
    size = F.lit(0).cast("long")
    for field in df.schema.fields:
        if field.dataType.typeName() in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(quoted(field.name)), F.lit(0)) + 16
        else:
            size = size + 16
    total = df.agg(F.sum(size)).first()[0]
    return F.broadcast(df) if (total or 0) <= limit else df


def quoted(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """``columns`` next to the whole row as struct ``row_``, so no name can clash."""
    row = F.struct(*[quoted(c) for c in docs.columns])
    return docs.select(row.alias("row_"), *[c.alias(n) for n, c in columns.items()])


def unpacked(rows: DataFrame, names: list[str], **columns: Column) -> DataFrame:
    """The whole rows again, with ``columns`` in place of or behind their own."""
    own = F.col("row_")
    kept = [columns.pop(n).alias(n) if n in columns else own.getField(n).alias(n) for n in names]
    return rows.select(*kept, *[c.alias(n) for n, c in columns.items()])


def worker_state(key: str, build: Callable[[], object]) -> object:
    """What ``build`` returns, kept for the tasks of one Python worker until it works on
    something else: a worker outlives a job and must not add up what all of them remember."""
    home = sys.modules.setdefault("_lakemark_llm_state", types.ModuleType("_lakemark_llm_state"))
    held = home.__dict__.setdefault("held", {})
    if key not in held:
        held.clear()
        gc.collect()
        give_back()
        held[key] = build()
    else:
        give_back()
    return held[key]


def give_back() -> None:
    """Return the memory that earlier tasks of this worker have freed to the system; both allocators
    would keep it, and the worker idles while the executor needs it elsewhere."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of GNU has it
    if trim:
        trim(0)


def text_slices(
    batches: Iterator[pa.RecordBatch], field: int | None = None, limit: int = SLICE_CHARS
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds at most ``limit`` bytes of text or one row.

    The text is the last column, or field ``field`` of the struct in the first one.
    """
    for batch in batches:
        text = batch.column(batch.num_columns - 1) if field is None else batch.column(0).field(field)
        ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
