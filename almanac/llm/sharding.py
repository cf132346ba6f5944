"""Placement of rows on shards through a permutation-filled lookup table. DataFrame functions only on the rows' path.

The table has a prime number of slots. Every shard has its own order of preference over them (an offset and a step from
a hash of its name); shards take turns, each claiming its first slot still free, until all are taken. Shares differ by
one slot at most, and removing a shard moves little besides its own slots. The table depends only on the shards' names,
never on data: at most MOST_SLOTS rows, which is the proven bound of what is broadcast (more slots are refused). A row's
place is one hash and one lookup.

Defined cases: a null key is a key like any other, so its rows lie together; rows with equal keys lie together, in any
number (placing shuffles nothing, so no key is too frequent); an empty table gives no rows; a column named slot or
shard, in any case, gives way to the result's, and every other column is kept, whatever its name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLOTS = 65_537
#: The most slots, and so the most rows that are broadcast.
MOST_SLOTS = 1 << 20
SHARDS = tuple(f"shard-{i:03d}" for i in range(128))


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % i for i in range(2, int(n**0.5) + 1))


def _number(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def lookup(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """For each slot, the number of its shard."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, one at least")
    if not _is_prime(slots) or slots < len(shards) or slots > MOST_SLOTS:
        raise ValueError(f"slots must be a prime number up to {MOST_SLOTS}, and at least as many as shards")
    at = [_number(s, "offset") % slots for s in shards]
    step = [_number(s, "step") % (slots - 1) + 1 for s in shards]
    owner, free = [-1] * slots, slots
    while free:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            owner[at[i]] = i
            free -= 1
            if not free:
                break
    return owner


def table(spark: SparkSession, shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    return spark.createDataFrame([(i, shards[s]) for i, s in enumerate(lookup(shards, slots))], "slot int, shard string")


def slot_of(*keys: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def place(df: DataFrame, keys: Sequence[str], shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """df with slot and shard of each row."""
    own = [F.col(f"`{c}`") for c in df.columns if c.lower() not in ("slot", "shard")]
    # all columns travel in a struct, so that no name of theirs can clash with the lookup's
    slotted = df.select(F.struct(*own).alias("row"), slot_of(*[df[k] for k in keys], slots=slots).alias("slot"))
    placed = slotted.join(F.broadcast(table(df.sparkSession, shards, slots)), "slot")
    return placed.select("row.*", "slot", "shard")


def balance(placed: DataFrame, weight: Column | None = None) -> DataFrame:
    """Rows and weight of each shard."""
    return placed.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum(weight if weight is not None else F.lit(1)).alias("weight"))
