"""A bit sketch of a key column: which rows of another table cannot share a key.

Keys are hashed into a fixed number of bits, kept as 4 KB bitmaps. Rows whose bit
is not set hold no key of the sketched table and need not be shuffled to meet it;
rows whose bit is set may. Nothing is lost at any size: a fuller sketch lets more
rows through. Null keys share one bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits in one bitmap, and bits of a whole sketch: 512 bitmaps, 2 MB, is all that
#: is ever broadcast.
BITMAP_BITS = 1 << 15
SKETCH_BITS = 1 << 24

_BUCKET, _BITS = "_sketch_bucket", "_sketch_bits"


def _bit(key: str | Column, bits: int) -> Column:
    """The number of a key's bit, from 1."""
    return F.pmod(F.xxhash64(key), F.lit(bits)) + F.lit(1)


def key_sketch(df: DataFrame, key: str, bits: int = SKETCH_BITS) -> DataFrame:
    """(bucket, bits): the sketch of a key column; bitmaps are combined map-side."""
    h = _bit(F.col(key), bits)
    return df.groupBy(F.bitmap_bucket_number(h).alias(_BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(h)).alias(_BITS))


def mark_held(df: DataFrame, sketch: DataFrame, key: str, name: str, bits: int = SKETCH_BITS) -> DataFrame:
    """``df`` with a boolean column ``name``: whether the key may be in the sketch."""
    h = _bit(F.col(key), bits)
    at = F.bitmap_bit_position(h)
    byte = F.conv(F.hex(F.substring(F.col(_BITS), F.floor(at / 8).cast("int") + F.lit(1), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (at % 8).cast("int")) == 1
    joined = df.withColumn("_sketch_of", F.bitmap_bucket_number(h)).join(
        F.broadcast(sketch), F.col("_sketch_of") == F.col(_BUCKET), "left")
    return joined.withColumn(name, F.coalesce(is_set, F.lit(False))).drop("_sketch_of", _BUCKET, _BITS)
