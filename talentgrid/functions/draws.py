"""Draws that depend on the row's key alone.

A replayed task or micro-batch must emit the same rows, so chance comes from a
digest of the key and not from ``rand()``.  One MD5 digest holds four
independent 32-bit lanes, hence four draws for one hash.

A pair of records is too frequent an object to hash text for.  Each record gets a
seed once; the product of two seeds modulo a prime is the pair's residue, and
multiplying that by a constant per purpose modulo a second prime gives one draw
per purpose.  That is two integer multiplications, exact in 64 bits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

LANE_RANGE = 2**32
#: the two largest primes below 2**31
PAIR_PRIME, DRAW_PRIME = 2147483647, 2147483629


def digest(*key: Column) -> Column:
    return F.md5(F.concat_ws("|", *key))


def lane(hex_digest: Column, index: int = 0) -> Column:
    """Lane ``index`` (0-3) of a digest, a whole number below 2**32."""
    return F.conv(F.substring(hex_digest, 8 * index + 1, 8), 16, 10).cast("bigint")


def unit(hex_digest: Column, index: int = 0) -> Column:
    """A draw from [0, 1)."""
    return lane(hex_digest, index) / F.lit(float(LANE_RANGE))


def whole(hex_digest: Column, size: Column, index: int = 0) -> Column:
    """A draw from 0 .. size-1 in exact integer arithmetic."""
    return F.shiftright(lane(hex_digest, index) * size.cast("bigint"), 32)


def between(hex_digest: Column, low: Column, high: Column, index: int = 0) -> Column:
    """A draw from the closed range low .. high."""
    return low + whole(hex_digest, high - low + 1, index)


def pick(hex_digest: Column, options: Column, index: int = 0) -> Column:
    """One element of an array; NULL for an empty one."""
    return F.get(options, whole(hex_digest, F.size(options), index).cast("int"))


def sample(options: Column, size: Column, *key: Column) -> Column:
    """``size`` elements of an array, no position twice, in draw order."""
    tagged = F.transform(
        options,
        lambda item, at: F.struct(digest(*key, at.cast("string")).alias("draw"), item.alias("item")),
    )
    chosen = F.slice(F.array_sort(tagged), F.lit(1), F.greatest(size, F.lit(0)))
    return F.transform(chosen, lambda entry: entry["item"])


def keyed_id(*key: Column) -> Column:
    """An identifier in UUID form that a replay gives again."""
    text = digest(*key)
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(text, start, size) for start, size in cuts])


def seed(hex_digest: Column, index: int = 0) -> Column:
    """A seed in 1 .. DRAW_PRIME-1 for a record or a purpose."""
    return lane(hex_digest, index) % (DRAW_PRIME - 1) + 1


def pair_residue(left_seed: Column, right_seed: Column) -> Column:
    return left_seed * right_seed % PAIR_PRIME


def random_residue(random_seed: int) -> Column:
    """Stands in for :func:`pair_residue` where draws need not survive a replay."""
    return (F.rand(random_seed) * (PAIR_PRIME - 1)).cast("bigint") + 1


def pair_draw(residue: Column, purpose_seed: Column) -> Column:
    """A whole number below DRAW_PRIME."""
    return residue * purpose_seed % DRAW_PRIME


def least_draw(share: float) -> int:
    """The smallest draw whose :func:`pair_unit` is not below ``share``; draws below it are the share."""
    draw = math.ceil(share * DRAW_PRIME)
    while draw > 0 and (draw - 1) / float(DRAW_PRIME) >= share:
        draw -= 1
    while draw / float(DRAW_PRIME) < share:
        draw += 1
    return draw


def pair_unit(residue: Column, purpose_seed: Column) -> Column:
    """A draw from [0, 1)."""
    return pair_draw(residue, purpose_seed) / F.lit(float(DRAW_PRIME))
