"""A stored index of keys: Bloom filters in blocks, one set for each partition
of the keyed table (here a month).

A key's hash picks one block of ``BLOCK_BITS`` bits and ``HASHES`` bits in it, so
a filter of any size is a table (partition, blocks, block, bits) that Spark
builds with one aggregation and probes with one join on the block.  A probe
answers "not there" for sure and "maybe there" with a few per cent of false
positives; callers resolve those against the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# A bitmap of Spark's bitmap functions.
BLOCK_BITS = 32768
HASHES = 7
BITS_PER_KEY = 10


def key_hash(*keys: Column) -> Column:
    return F.xxhash64(*keys)


def _blocks(n: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(n * BITS_PER_KEY / BLOCK_BITS)).cast("long")


def _positions(h: Column) -> list[Column]:
    """Bit numbers within the block, by double hashing of a second hash."""
    again = F.xxhash64(h, F.lit(1))
    first, step = F.pmod(again, F.lit(BLOCK_BITS)), F.pmod(F.shiftright(again, 20), F.lit(BLOCK_BITS // 2)) * 2 + 1
    return [F.pmod(first + k * step, F.lit(BLOCK_BITS)) for k in range(HASHES)]


def build(keys: DataFrame, partition: str, h: str = "_key") -> DataFrame:
    """(partition, blocks, block, bits) of the key hashes ``h``."""
    sizes = keys.groupBy(partition).agg(_blocks(F.count(F.lit(1))).alias("blocks"))
    rows = keys.select(partition, h).join(sizes, partition)
    bits = rows.select(partition, "blocks", F.pmod(h, F.col("blocks")).alias("block"), F.explode(F.array(*_positions(F.col(h)))).alias("_bit"))
    return bits.groupBy(partition, "blocks", "block").agg(F.bitmap_construct_agg("_bit").alias("bits"))


def _bit_is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (position % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def maybe_present(keys: DataFrame, index: DataFrame, partition: str, h: str = "_key") -> DataFrame:
    """``keys`` that may be in one of the filters of ``index`` (with several runs
    of one partition: ``run``), each once."""
    sizes = index.select(partition, "run", "blocks").distinct()
    asked = keys.join(sizes, partition).withColumn("block", F.pmod(h, F.col("blocks")))
    hit = asked.join(index.select(partition, "run", "block", "bits"), [partition, "run", "block"])
    for position in _positions(F.col(h)):
        hit = hit.filter(_bit_is_set(F.col("bits"), position))
    return hit.select(*keys.columns).distinct()
