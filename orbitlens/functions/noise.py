"""Randomness by counters: draws that are functions of what they belong to, not of where a row lies.

A draw hashes (seed, epoch, key, position), so it is the same under every layout, retry and engine that knows md5.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from orbitlens.functions.scalars import HASH_RANGE, hash_draw

_UNIT = 1 << 52


def _text(keys: list[str], seed: int, epoch: int, *more: Column) -> Column:
    named = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.concat_ws(":", F.lit(str(seed)), F.lit(str(epoch)), *named, *[c.cast("string") for c in more])


def epoch_order(keys: list[str], seed: int, epoch: int) -> Column:
    """A text to sort rows by: an order drawn anew for every epoch."""
    return F.md5(_text(keys, seed, epoch))


def epoch_worker(keys: list[str], seed: int, epoch: int, workers: int) -> Column:
    """The worker of a row in an epoch, from 0."""
    return (hash_draw([F.lit(str(epoch)), *keys], seed) * workers / HASH_RANGE).cast("int")


def _unit(digits: Column, first: int) -> Column:
    """52 bits of a hash as a number inside (0, 1)."""
    return (F.conv(F.substring(digits, first, 13), 16, 10).cast("bigint") + 0.5) / _UNIT


def normal_draws(keys: list[str], seed: int, epoch: int, n: int) -> Column:
    """n standard Normal draws of a row as an array (Box-Muller over two parts of one hash)."""

    def one(position: Column) -> Column:
        # an array of one hash, so that it is computed once
        return F.get(F.transform(F.array(F.md5(_text(keys, seed, epoch, position))), lambda h: F.sqrt(
            -2 * F.ln(_unit(h, 1))) * F.cos(2 * math.pi * _unit(h, 14))), F.lit(0))

    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), one)
