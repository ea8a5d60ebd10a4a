"""A bitmap of seen links that is tested in front of the exact anti-join.

Bits are kept as a table of bitmaps, one row for each stretch of hashes that has any link, built
by Spark's bitmap aggregates. A link whose bit is not set is new without a further look; only
possible hits meet the seen links, and of those only the ones that a bitmap of the possible hits
lets through. With ``BITS`` = 2^31 positions and n links seen,
a new link is a possible hit with a chance of n / 2^31; the exact join sorts those out.

The bitmaps are broadcast up to ``BROADCAST_BYTES`` (by their counted size); beyond that they meet
the links' positions by a shuffle of (stretch, position) pairs, a few bytes a link.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postloom.operators.dedup import keep_first
from postloom.operators.seen import with_url
from postloom.session import cut_lineage

BITS = 1 << 31
BROADCAST_BYTES = 64 << 20
_BUCKET_BYTES = 4096  # of Spark's bitmap aggregates
_STRETCH, _BIT, _MAP = "__stretch", "__bit", "__bitmap"


def _position(url: str) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(BITS))


def seen_bitmap(seen: DataFrame, url: str = "url") -> DataFrame:
    """(stretch, bitmap) of all links in ``seen``; partial bitmaps combine before the shuffle."""
    at = seen.select(_position(url).alias("__at"))
    return at.groupBy(F.bitmap_bucket_number("__at").alias(_STRETCH)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__at")).alias(_MAP))


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("int"), (bit % 8).cast("int")) == 1


def possible_hits(df: DataFrame, bitmap: DataFrame, url: str, maps: int) -> DataFrame:
    """``df`` with a flag ``__possible``: the link's bit is set."""
    at = _position(url)
    placed = df.withColumns({_STRETCH: F.bitmap_bucket_number(at), _BIT: F.bitmap_bit_position(at)})
    if maps * _BUCKET_BYTES <= BROADCAST_BYTES:
        bitmap = F.broadcast(bitmap)
    flagged = placed.join(bitmap, _STRETCH, "left").withColumn(
        "__possible", F.coalesce(_is_set(F.col(_MAP), F.col(_BIT)), F.lit(False)))
    return flagged.drop(_STRETCH, _BIT, _MAP)


def unseen_by_bitmap(
    df: DataFrame, seen: DataFrame, url: str, order: list[str], bitmap: DataFrame | None = None,
) -> DataFrame:
    """Same rows as :func:`postloom.operators.seen.unseen`, shuffling possible hits only.

    ``bitmap``: that of ``seen`` from an earlier run, if it is kept.
    """
    bitmap = cut_lineage(seen_bitmap(seen) if bitmap is None else bitmap)
    flagged = cut_lineage(possible_hits(with_url(df, url), bitmap, url, bitmap.count()))
    # a link is either possible or new in all its rows, so the two parts share no link
    new = keep_first(flagged.where("not __possible").drop("__possible"), [url], order)
    doubtful = keep_first(flagged.where("__possible").drop("__possible"), [url], order)
    # of the seen links, too, only those that a doubtful one may equal are shuffled
    asked = cut_lineage(seen_bitmap(doubtful, url))
    known = possible_hits(with_url(seen, "url"), asked, "url", asked.count())
    known = known.where("__possible").select(F.col("url").alias("__seen"))
    missed = doubtful.join(known, F.col(url) == F.col("__seen"), "left_anti")
    return new.unionByName(missed)
