"""Places of rows inside the groups of a range-partitioned table.

ranked() sorts a table by (key, order) over range partitions and numbers the rows
of each key from 0. A partition counts its own part of a key while it streams by;
only the key that a partition opens with can have rows in earlier partitions, so
one offset per partition completes the count. A key of any size spreads over many
partitions, and no task holds a whole key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BATCH_BYTES, materialize, ship


def starts_of(keys: list[pa.Array]) -> np.ndarray:
    """Whether each row (but the first) differs from the one before it."""
    n = len(keys[0])
    new = np.zeros(max(0, n - 1), bool)
    for k in keys:
        new |= pc.not_equal(k.slice(1), k.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    return new


def _local(key: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, seen, first = None, 0, None
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            k = b.column(key)
            start = np.flatnonzero(np.append(True, starts_of([k])))
            at = np.arange(n) - np.repeat(start, np.diff(np.append(start, n)))
            head = k[0].as_py()
            if first is None:
                first = head
            if head == last:
                at[:start[1] if len(start) > 1 else n] += seen
            last, seen = k[n - 1].as_py(), int(at[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array(np.full(n, part, np.int32)), pa.array(at.astype(np.int64)), pc.equal(k, pa.scalar(first, k.type))],
                [*names, "part_", "at_", "opens_"])

    return run


def ranked(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The rows of `df` with `rank`, their place from 0 among the rows of their
    `key` (a non-null string) in the order of `order`; rows that are equal in
    `order` are numbered in any order. Written once, read often."""
    ship(df.sparkSession)
    names = df.columns
    # equal rows are dealt out too; a row's place in the scan settles ties
    tied = df.withColumn("tie_", F.monotonically_increasing_id())
    dealt = tied.repartitionByRange(F.col(key), *order, F.col("tie_")).sortWithinPartitions(F.col(key), *order, F.col("tie_")).drop("tie_")
    more = T.StructType.fromDDL("part_ int, at_ long, opens_ boolean").fields
    rows = materialize(dealt.mapInArrow(_local(key, names), T.StructType([*df.schema.fields, *more])))
    # rows of the opening key in earlier partitions: one row per partition
    held = rows.groupBy(key, "part_").agg(F.count("*").alias("n"), F.max("opens_").alias("opens_"))
    before = Window.partitionBy(key).orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.withColumn("before_", F.sum("n").over(before)).filter("opens_ AND before_ > 0").select("part_", F.lit(True).alias("opens_"), "before_")
    return rows.join(F.broadcast(offsets), ["part_", "opens_"], "left").select(*names, (F.col("at_") + F.coalesce("before_", F.lit(0))).alias("rank"))


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, list[pa.RecordBatch]]]:
    """Groups of a partition that is sorted by `keys`, one after another."""
    last, held = None, []
    for b in batches:
        if not b.num_rows:
            continue
        cuts = [0, *(np.flatnonzero(starts_of([b.column(k) for k in keys])) + 1).tolist(), b.num_rows]
        for s, e in zip(cuts, cuts[1:], strict=False):
            name = tuple(b.column(k)[s].as_py() for k in keys)
            if held and name != last:
                yield last, held
                held = []
            last = name
            held.append(b.slice(s, e - s))
    if held:
        yield last, held


def _joined(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from pa.Table.from_batches(batches).combine_chunks().to_batches()


def map_groups(df: DataFrame, keys: list[str], order: list[str], run: Callable, schema) -> DataFrame:
    """run(key values, rows of the group as one table) -> batches, for every
    group of `keys` (not null); for groups of bounded size."""
    def each(batches):
        held, size = [], 0
        for name, rows in by_group(batches, keys):
            for b in run(name, pa.Table.from_batches(rows).combine_chunks()):
                held.append(b)
                size += b.nbytes
            if len(held) >= 512 or size >= BATCH_BYTES:
                yield from _joined(held)
                held, size = [], 0
        if held:
            yield from _joined(held)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(each, schema)
