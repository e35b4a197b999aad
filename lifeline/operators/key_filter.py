"""A key set of any size as a bounded filter ahead of an aggregate.

The keys' hashes set bits of a bitmap, built by ``bitmap_construct_agg`` in pieces
of 32,768 bits, one row each.  The bitmap has 16 bits for each key up to a given
number of bits, so its broadcast has a fixed bound however many keys there are.
A row whose bit is not set can't have one of the keys; of the others a share
passes without need (about 6 % at 16 bits a key, more where the bound cuts the
bits), so an exact join must follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: bits of one ``bitmap_construct_agg`` bitmap.
PIECE_BITS = 32_768
BITS_PER_KEY = 16


def bitmap_bits(n_keys: int, max_bits: int) -> int:
    """Bits for ``n_keys`` keys: a power of two, one piece at least."""
    bits = PIECE_BITS
    while bits < BITS_PER_KEY * n_keys and 2 * bits <= max_bits:
        bits *= 2
    return bits


def _bit(key: Column, bits: int) -> Column:
    return F.xxhash64(key).bitwiseAND(bits - 1)


def key_bitmap(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(_piece, _bitmap) of the non-null keys; pieces without a key are left out."""
    bit = _bit(F.col(key), bits)
    return (
        keys.where(F.col(key).isNotNull())
        .select(F.shiftright(bit, 15).alias("_piece"), bit.bitwiseAND(PIECE_BITS - 1).alias("_place"))
        .groupBy("_piece")
        .agg(F.bitmap_construct_agg("_place").alias("_bitmap"))
    )


def may_have_key(df: DataFrame, key: str, bitmap: DataFrame, bits: int) -> DataFrame:
    """The rows of ``df`` whose ``key`` may be in the set; nothing is shuffled."""
    bit = _bit(F.col(key), bits)
    place = bit.bitwiseAND(PIECE_BITS - 1).cast("int")
    byte = F.conv(F.hex(F.substr("_bitmap", F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, place.bitwiseAND(7)) == 1
    return df.join(F.broadcast(bitmap), (F.shiftright(bit, 15) == F.col("_piece")) & is_set, "left_semi")
