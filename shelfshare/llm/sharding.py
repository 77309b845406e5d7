"""Sharding by a permutation-filled lookup table.

Each shard has a preference order over the slots of a table of prime size, given by an offset and a skip. Shards take turns
claiming their next free slot until the table is full, so that each gets an equal share, and a lost shard moves little else.
The table has `slots` entries whatever the data, is broadcast, and places a row in constant time.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537


def _hash(name: str, salt: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8, salt=salt).digest(), "big")


def lookup_table(shards: list[str], slots: int = SLOTS) -> np.ndarray:
    """The index of the shard that owns each slot. slots must be prime and not below the number of shards; names must differ."""
    if not shards or len(set(shards)) < len(shards) or slots < len(shards) or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError("distinct shard names and a prime number of slots, at least as many, are needed")
    offset = [_hash(s, b"offset") % slots for s in shards]
    skip = [_hash(s, b"skip") % (slots - 1) + 1 for s in shards]
    table, free = np.full(slots, -1), slots
    while True:
        for i in range(len(shards)):
            while table[offset[i]] >= 0:
                offset[i] = (offset[i] + skip[i]) % slots
            table[offset[i]] = i
            free -= 1
            if not free:
                return table


def slot(key: Column, slots: int = SLOTS) -> Column:
    """The slot of a key: its 64-bit hash modulo the table's size. A null key has a slot as well."""
    return F.pmod(F.xxhash64(key), F.lit(slots))


def place(df: DataFrame, key: str, shards: list[str], slots: int = SLOTS, shard_col: str = "shard", slot_col: str = "slot") -> DataFrame:
    """df with the slot and the name of the shard that a row belongs to, as its last two columns.

    Equal keys share a shard, null keys too; repeated rows all stay; an empty table stays empty. Columns of df that have the
    name of one of the two are replaced by it, also the key.
    """
    if slot_col.lower() == shard_col.lower():
        raise ValueError("slot and shard need different names")
    own, table = "_slot_of_row", lookup_table(shards, slots)
    while own.lower() in {c.lower() for c in df.columns}:
        own += "_"
    side = df.sparkSession.createDataFrame([(i, shards[s]) for i, s in enumerate(table.tolist())], f"{own} long, {own}_shard string")
    rest = [f"`{c}`" for c in df.columns if c.lower() not in (slot_col.lower(), shard_col.lower())]
    found = df.select("*", slot(F.col(f"`{key}`"), slots).alias(own)).join(F.broadcast(side), own)  # as many rows as slots
    return found.select(*rest, F.col(own).alias(slot_col), F.col(f"{own}_shard").alias(shard_col))


def write_sharded(df: DataFrame, key: str, shards: list[str], path: str, slots: int = SLOTS) -> None:
    """One folder per shard. Slots, not shards, deal the rows to tasks, so that a large shard is written by many."""
    place(df, key, shards, slots).repartition("slot").write.partitionBy("shard").parquet(path)
