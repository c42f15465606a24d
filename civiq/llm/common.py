"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civiq.session import ensure_checkpoint_dir, materialize  # noqa: F401

#: Stands for a null id where ids are compared: larger than any other id.
NULL_ID = (1 << 63) - 1

#: Bytes of an Arrow batch that a Python task gets at once.
BATCH_BYTES = 8 << 20

_SHIPPED = "_civiq_package_shipped"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per context, so that the Python
    tasks can import it wherever they run; and bound the bytes of a batch that
    goes to Python, as texts may be long (a smaller setting is left alone)."""
    sc = spark.sparkContext
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(re.sub(r"\D", "", spark.conf.get(size))) > BATCH_BYTES:
        spark.conf.set(size, str(BATCH_BYTES))
    if getattr(sc, _SHIPPED, False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="civiq-code-"), "civiq_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    setattr(sc, _SHIPPED, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    ensure_checkpoint_dir(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: Column, modulus: int, value: int) -> Column:
    """crc32(id as text) mod modulus = value; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus == value, F.lit(False))


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Total bytes of a text column (one aggregate row)."""
    return docs.select(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).head()[0]


def unused(df: DataFrame, name: str) -> str:
    """A column name like `name` that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns(df: DataFrame) -> list[Column]:
    """All columns, whatever their names hold."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def first_by_hash(df: DataFrame, key: str, n: int, *ties: str, total: int | None = None) -> DataFrame:
    """At most n rows, the first by a hash of `key`. The hash is cut first, so
    that each task sends a share of about 3n rows and not n rows of its own."""
    total, h = df.count() if total is None else total, F.xxhash64(key)
    if total > 4 * n:
        df = df.filter(h < F.lit(-(1 << 63) + (1 << 64) * 3 * n // total))
    return df.orderBy(h, key, *ties).limit(n)


def with_row(df: DataFrame, more: str) -> T.StructType:
    """Schema of the column `row` of a table and further columns."""
    return T.StructType([T.StructField("row", df.schema["row"].dataType), *T.StructType.fromDDL(more).fields])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release() -> None:
    """Give freed memory of a Python worker back to the machine; workers live
    on between tasks, beside the JVM."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


class WordHashes(dict):
    """word (bytes) -> XXH64; keeps no long words and is emptied when it has
    grown past its bound."""

    BOUND, LONG = 250_000, 64

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, 42)
        if len(word) <= self.LONG:
            self[word] = h
        return h

    def trim(self) -> None:
        if len(self) > self.BOUND:
            self.clear()

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def values(column: pa.Array, step: int = 256) -> Iterator:
    """A column's Python values, a few rows at a time."""
    for at in range(0, len(column), step):
        yield from column.slice(at, step).to_pylist()


def chunks(items: Iterable, size, limit: int) -> Iterator[list]:
    """Lists of items whose sizes sum to about `limit` (the last one may be
    smaller; an item over the limit makes a list of its own)."""
    part, total = [], 0
    for x in items:
        part.append(x)
        total += size(x)
        if total >= limit:
            yield part
            part, total = [], 0
            release()
    if part:
        yield part
    release()


def runs(sorted_keys: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Start index of every run of equal keys in sorted arrays."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    new = np.ones(len(sorted_keys), bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    for k in more:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)
