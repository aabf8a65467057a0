"""Shuffle, index, batch and shard (K1-K6).

All positions come from the distributed dense index (K2), so batches and
shards are reproducible and no step sorts the data in one task.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recprep.functions.random import uniform
from recprep.operators.indexing import with_row_index

#: a prime that products of two numbers below it keep within a signed long
PRIME = (1 << 31) - 1
EPOCH_ROUNDS = 32


def shuffle_key(seed: int, epoch: int, *keys) -> Column:
    """K1's sort key: a J9 draw per row, new for every epoch."""
    return uniform(seed, epoch, *keys)


def shuffle_rows(df: DataFrame, seed: int, epoch: int, keys, index: str = "row_idx") -> DataFrame:
    """K1: seeded permutation; ``index`` is each row's position in it.

    ``keys`` must identify rows uniquely (they seed the draw and break ties).
    A full distributed shuffle, not a bounded buffer.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    k = df.withColumn("_sh_key", shuffle_key(seed, epoch, *keys))
    return with_row_index(k, ["_sh_key", *keys], name=index).drop("_sh_key")


def _epoch_rounds(seed: int, epoch: int, rounds: int) -> list[tuple[int, int, int, int]]:
    """The numbers of each round, from md5 of (seed, epoch, round): an offset
    (to be taken modulo the row count) and three coefficients below PRIME."""
    out = []
    for r in range(rounds):
        h = [int(hashlib.md5(f"{seed}|{epoch}|{r}|{j}".encode()).hexdigest()[:13], 16) for j in range(4)]
        out.append((h[0], 1 + h[1] % (PRIME - 1), 1 + h[2] % (PRIME - 1), h[3] % PRIME))
    return out


def epoch_positions(df: DataFrame, n: int, seed: int, epoch: int, index: str = "row_idx",
                    name: str = "position", rounds: int = EPOCH_ROUNDS) -> DataFrame:
    """K1 for one more epoch over rows that have a dense index 0..n-1: the place
    of each row in the epoch's order, a bijection of [0, n) computed row by row,
    so a new epoch needs neither a sort nor a shuffle.

    Swap-or-not rounds: a round pairs x with (offset - x) mod n and, if a bit
    hashed from the larger of the two says so, takes the partner. Both members
    of a pair see the same bit, so every round is a bijection for any n. A null
    index stays null; an index outside [0, n) is an error of the caller.
    """
    if n < 1:
        return df.withColumn(name, F.lit(None).cast("bigint"))
    steps = F.array(*[F.struct(*[F.lit(v).cast("bigint").alias(c) for c, v in
                                 zip("kabc", (k % n, a, b, c))]) for k, a, b, c in
                      _epoch_rounds(seed, epoch, rounds)])

    def one(x, s):
        partner = F.pmod(s["k"] - x, F.lit(n).cast("bigint"))
        high = F.greatest(x, partner)
        mixed = ((high % PRIME) * s["a"] + (high / PRIME).cast("bigint") * s["b"] + s["c"]) % PRIME
        return F.when(mixed * 2 < PRIME, partner).otherwise(x)

    return df.withColumn(name, F.aggregate(steps, F.col(index).cast("bigint"), one))


def epoch_positions_sql(table: str, index: str, n: str, seed: int, epoch: int,
                        rounds: int = EPOCH_ROUNDS, name: str = "position") -> str:
    """The same bijection as SQL: a query adding ``name`` to ``table``; ``n`` is
    a scalar SQL expression."""
    sql = f"SELECT *, CAST({index} AS BIGINT) AS {name} FROM {table}"
    for k, a, b, c in _epoch_rounds(seed, epoch, rounds):
        pair = f"SELECT *, (({k} % {n}) - {name} + {n}) % {n} AS _p FROM ({sql}) q"
        high = f"greatest({name}, _p)"
        bit = f"(({high} % {PRIME}) * {a} + ({high} // {PRIME}) * {b} + {c}) % {PRIME} * 2 < {PRIME}"
        sql = f"SELECT * EXCLUDE (_p) REPLACE (CASE WHEN {bit} THEN _p ELSE {name} END AS {name}) FROM ({pair}) q"
    return sql


def assign_batches(df: DataFrame, size: int, drop_last: bool = False, order=None,
                   index: str = "row_idx", batch: str = "batch_id") -> DataFrame:
    """K3: ``batch_id = index div size``; ``drop_last`` removes the short
    final batch. Uses an existing ``index`` column or builds one on ``order``."""
    if size < 1:
        raise ValueError("batch size must be >= 1")
    if index not in df.columns:
        if order is None:
            raise ValueError("need an index column or an order to build one")
        df = with_row_index(df, order, name=index)
    out = df.withColumn(batch, F.floor(F.col(index) / size).cast("bigint"))
    if drop_last:
        full = (df.count() // size) * size
        out = out.where(F.col(index) < full)
    return out


def shard_rows(df: DataFrame, world: int, rank: int | None = None, index: str = "row_idx",
               shard: str = "shard") -> DataFrame:
    """K4: every ``world``-th row to one shard (``index mod world``); with
    ``rank`` only that shard is kept."""
    out = df.withColumn(shard, (F.col(index) % world).cast("int"))
    return out if rank is None else out.where(F.col(shard) == rank)


def shard_even(df: DataFrame, world: int, seed: int, epoch: int, keys,
               shuffle: bool = True, order=None) -> DataFrame:
    """K5: equal-length shards with no row dropped: the permutation is
    padded with its first rows (repeated as needed) up to a multiple of
    ``world``; shard = position mod world, ``local_pos`` = position div world.
    """
    if shuffle:
        idx = shuffle_rows(df, seed, epoch, keys, index="_se_idx")
    else:
        idx = with_row_index(df, order if order is not None else keys, name="_se_idx")
    n = idx.count()
    total = math.ceil(n / world) * world if n else 0
    pad = total - n
    base = idx.withColumn("position", F.col("_se_idx"))
    if pad > 0:
        reps = F.ceil((F.lit(total - n) - F.col("_se_idx")) / F.lit(n)).cast("int")
        extra = (idx.where(F.col("_se_idx") < pad)
                    .withColumn("_rep", F.explode(F.sequence(F.lit(1), F.greatest(reps, F.lit(1)))))
                    .withColumn("position", F.col("_se_idx") + F.col("_rep") * n)
                    .where(F.col("position") < total).drop("_rep"))
        base = base.unionByName(extra)
    return (base.withColumn("shard", (F.col("position") % world).cast("int"))
                .withColumn("local_pos", F.floor(F.col("position") / world).cast("bigint"))
                .drop("_se_idx"))


def plan_steps(n: int, batch: int, drop_last: bool) -> int:
    """K6: steps per epoch (floor when the short batch is dropped, else ceil)."""
    return n // batch if drop_last else math.ceil(n / batch)


def steps_frame(df: DataFrame, per_device_batch: int, devices: int = 1) -> DataFrame:
    """K6 as a query: rows, global batch and both step counts."""
    b = per_device_batch * devices
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(b).cast("bigint").alias("global_batch"),
        F.floor(F.col("n_rows") / b).cast("bigint").alias("steps_drop_last"),
        F.ceil(F.col("n_rows") / b).cast("bigint").alias("steps_keep_last"))


def shard_batches(df: DataFrame, world: int, size: int, index: str = "row_idx",
                  shard: str = "shard", batch: str = "batch_id") -> DataFrame:
    """K4 + K3 per rank: rows dealt round-robin to ``world`` shards, then
    batched in order inside each shard (what each rank's loader sees)."""
    local = F.floor(F.col(index) / world)
    return (df.withColumn(shard, (F.col(index) % world).cast("int"))
              .withColumn(batch, F.floor(local / size).cast("bigint")))


def to_jagged(df: DataFrame, batch: str, order: str, values: str, pad: int | None = 0) -> DataFrame:
    """Per batch, the flat value list and per-row lengths and offsets
    (a jagged tensor); ``pad`` values are dropped first. Each batch gathers
    only its own rows."""
    vals = F.filter(values, lambda x: x != F.lit(pad)) if pad is not None else F.col(values)
    rows = df.select(batch, order, vals.alias("_v"))
    g = rows.groupBy(batch).agg(F.array_sort(F.collect_list(F.struct(order, "_v"))).alias("_r"))
    lengths = F.transform("_r", lambda x: F.size(x["_v"]))
    # exclusive prefix sums in one fold: the running sum and what it was before each row
    start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("seen"))
    offsets = F.aggregate(lengths, start, lambda a, n: F.struct(
        (a["sum"] + n).alias("sum"), F.array_append(a["seen"], a["sum"]).alias("seen")),
        lambda a: a["seen"])
    return g.select(batch, F.flatten(F.transform("_r", lambda x: x["_v"])).alias("values"),
                    lengths.alias("lengths"), offsets.alias("offsets"))
