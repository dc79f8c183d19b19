"""A filter of bounded size that keeps rows without a partner out of a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of 64 bits, as a power of two: 8 MB of bits at most.
WORDS = 20


def _place(column: str) -> tuple[Column, Column]:
    """Where an id's bit is: word and bit."""
    h = F.xxhash64(column)
    return F.shiftrightunsigned(h, 64 - WORDS), h.bitwiseAND(63).cast("int")


def maybe_members(docs: DataFrame, members: DataFrame, inside: bool = True) -> DataFrame:
    """``docs`` without most rows whose doc_id is not in ``members``; no member is lost.

    ``inside=False`` gives the other rows, none of them a member. The bitmap of hashed ids has at most
    ``2 ** WORDS`` words, whatever the number of members, so it may be broadcast.
    """
    word, bit = _place("doc_id")
    words = members.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("bit"))
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    own = docs.withColumns({"word_": word, "bit_": bit})
    on = (F.col("word_") == F.col("word")) & (F.getbit("bits", F.col("bit_")) == 1)
    return own.join(F.broadcast(words), on, "left_semi" if inside else "left_anti").drop("word_", "bit_")
