"""A semi-join by a bitmap: drop most rows nobody asks for before anything is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: bits of the bitmap as a power of two; its table has at most 2 ** (BITMAP - 6) rows of 16 bytes,
#: only those that a key falls into. With 20 million keys a quarter of the other rows pass
BITMAP = 26
_WORD, _BITS = "__word", "__bits"


def _place(key: Column, bits: int) -> tuple[Column, Column]:
    """The word of 64 bits a key falls into, and its bit there."""
    mixed = F.xxhash64(key)
    word = mixed.bitwiseAND(F.lit((1 << (bits - 6)) - 1))
    return word, F.shiftrightunsigned(mixed, bits - 6).bitwiseAND(F.lit(63)).cast("int")


def keep_likely(df: DataFrame, key: Column, wanted: DataFrame, bits: int = BITMAP) -> DataFrame:
    """Rows of ``df`` whose key may be in ``wanted``, a one-column table of the same type.

    Keys are hashed into a bitmap of fixed size, which is joined by its words as a broadcast
    table whatever the number of keys; so no row of ``df`` moves. What passes must still be
    joined: a row that is wanted always passes, and the fuller the bitmap the more others do.
    Keys that are NULL never pass.
    """
    word, bit = _place(F.col(wanted.columns[0]), bits)
    asked = wanted.where(F.col(wanted.columns[0]).isNotNull()).select(
        word.alias(_WORD), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("one")
    )
    words = asked.groupBy(_WORD).agg(F.bit_or("one").alias(_BITS))
    word, bit = _place(key, bits)
    met = df.where(key.isNotNull()).join(F.broadcast(words), word == F.col(_WORD))
    seen = F.call_function("shiftrightunsigned", F.col(_BITS), bit).bitwiseAND(F.lit(1)) == 1
    return met.where(seen).drop(_WORD, _BITS)
