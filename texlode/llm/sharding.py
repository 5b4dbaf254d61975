"""Assigns rows to shards by a lookup table that the shards fill in turns.

Each shard prefers the slots of a prime-sized table in an order of its own, a
permutation from two digests of its name.  Shards take turns; at its turn, each
claims the first free slot of its order.  All shards get the same number of
slots but for one, and when a shard comes or goes, few slots change hands.  The
table is as large as ``slots``, whatever the data; it is broadcast, and a row
finds its shard by the digest of its key.

Defined results: rows with one key, repeated rows too, go to one shard; a null
key is the empty string; columns other than the key are passed on only if asked
for; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hexadecimal digits of a digest that make a number.
_DIGITS = 15


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:_DIGITS], 16)


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(shards: list[str], slots: int) -> list[int]:
    """Number of the shard that owns each slot."""
    if not is_prime(slots) or not 0 < len(shards) <= slots:
        raise ValueError("slots must be a prime number, at least as large as the number of shards")
    start = [_number(f"offset {name}") % slots for name in shards]
    step = [_number(f"skip {name}") % (slots - 1) + 1 if slots > 2 else 1 for name in shards]
    owner = [-1] * slots
    at = list(start)
    for turn in range(slots):
        shard = turn % len(shards)
        while owner[at[shard]] >= 0:
            at[shard] = (at[shard] + step[shard]) % slots
        owner[at[shard]] = shard
    return owner


def slot_of(key: Column, slots: int) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("bigint"), F.lit(slots))


def assign_shards(docs: DataFrame, shards: list[str], slots: int, key: str = "doc_id", keep: list[str] = ()) -> DataFrame:
    """``key``, its ``slot`` and its ``shard`` for every row, with the columns in ``keep``."""
    owner = lookup_table(shards, slots)
    rows = [(slot, shard) for slot, shard in enumerate(owner)]
    table = docs.sparkSession.createDataFrame(rows, "slot bigint, shard bigint")
    placed = docs.select(key, *keep, slot_of(F.col(key), slots).alias("slot"))
    return placed.join(F.broadcast(table), "slot").select(key, *keep, "slot", "shard")
