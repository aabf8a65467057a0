"""Popularity-weighted negative sampling.

An item's probability is its share of interaction rows. Laying the items out
on ``[0, total)`` in item order, item i owning ``[start_i, start_i + count_i)``,
a uniform integer draw ``r`` lands in exactly one item's range: that item is
a popularity-weighted draw. The range lookup is an equi-join on
``bucket = r div width`` (each item listed under the buckets its range
touches), then a range check. Because ``r`` is uniform, draws spread evenly
over buckets whatever the popularity skew, so the join has no hot key; the
bucket table has at most ``n_items + n_buckets`` rows. Above
the broadcast bounds it is packed, the ranges of a wider bucket as two arrays in
one row, so that draws stay where they are made. Where that is too large as
well, both sides are shuffled on the bucket and the ranges are hashed, so the
draws are not sorted.

A user's draws are numbered, and only the first distinct ones count. So every
user makes a first part of its draws (FIRST_DRAWS per item wanted), and only
users whose first part falls short make the others, which have the numbers and
values that they would have had at once: the sample is the same.

Draws come from J9 (seed, round, user, draw number), so results do not depend
on partitioning and have an exact SQL oracle. De-duplicating draws in draw
order is sequential sampling without replacement; dropping excluded items
first gives the same law over the remaining items.

Where popularity is steep, a user's draws may repeat too few items. The rest
of its sample is then decided by exponential waiting times, which give the
same law: an item of count c waits -ln(1 - u) / c. The most popular items
(HEAD_FACTOR * k, and one more for each item of the catalogue that the user
excludes) get a waiting time each. All others arrive as one Poisson process
whose rate is their total count: an arrival is a weighted draw from the range
of the tail, and the first arrival of an item is its waiting time. All that
arrives before the last drawn arrival is known, so a user is done once enough
items did. No user meets the catalogue.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recprep.functions.random import uniform
from recprep.operators.aggregates import popularity_rank
from recprep.operators.indexing import running_sum, spread, spread_tasks
from recprep.operators.joins import broadcast_bytes_limit, broadcast_limit, maybe_broadcast, table_bytes
from recprep.session import staged


#: ranges that one packed bucket holds on average
PACK = 4


@dataclass
class PopularityTable:
    spans: DataFrame       # item, count, start, end
    total: int
    n_items: int
    width: int
    item: str

    def _touched(self, width: int):
        return F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("end") - 1) / width)))

    @cached_property
    def ranges(self) -> DataFrame:
        """item, count, start, end, bucket"""
        return self.spans.withColumn("bucket", self._touched(self.width))

    @cached_property
    def ranked(self) -> DataFrame:
        """item, count, pop_rank (1-based, most popular first)"""
        return popularity_rank(self.spans.select(self.item, "count"), item=self.item)

    @property
    def pack_width(self) -> int:
        return self.width * PACK

    @cached_property
    def _packs(self) -> DataFrame:
        rows = self.spans.where(F.col("count") > 0).select(
            "start", F.col(self.item).alias("_i"), self._touched(self.pack_width).alias("_pack"))
        packs = rows.groupBy("_pack").agg(F.array_sort(F.collect_list(F.struct("start", "_i"))).alias("_s"))
        return staged(packs.select("_pack", F.transform("_s", lambda x: x["start"]).alias("_starts"),
                                   F.transform("_s", lambda x: x["_i"]).alias("_items")), "sampling-packs")

    def packs(self) -> DataFrame | None:
        """The ranges, about PACK to a row (``_pack``, ``_starts``, ``_items``), to
        broadcast; None above the bounds. A draw falls on each row alike, so
        it meets about PACK ranges, however these differ in length."""
        rows = math.ceil(self.total / self.pack_width)
        limit = broadcast_bytes_limit(self.spans)
        if rows > broadcast_limit(self.spans) or 16 * (self.n_items + rows) > limit:
            return None
        return F.broadcast(self._packs) if table_bytes(self._packs, rows) <= limit else None


def popularity_table(pop: DataFrame, item: str = "book_id", total: int | None = None,
                     n_buckets: int | None = None) -> PopularityTable:
    """Cumulative ranges and bucket listing for D1's ``(item, count)``."""
    pop = staged(pop.select(item, "count"), "popularity")
    n_items = pop.count()
    total = total if total is not None else pop.agg(F.sum("count")).first()[0] or 0
    nb = max(1, n_buckets or n_items)
    width = max(1, math.ceil(total / nb))
    cum = running_sum(pop.select(item, "count"), [item], "count", name="start", inclusive=False)
    cum = cum.withColumn("end", F.col("start") + F.col("count"))
    return PopularityTable(cum, int(total), int(n_items), int(width), item)


def popularity_draws(users: DataFrame, table: PopularityTable, seed: int, key: str = "user_id",
                     m_col: str = "m", round_no: int = 0, draw: str = "draw",
                     keep=(), first: int = 0) -> DataFrame:
    """``m`` weighted draws (with replacement) per user ->
    (user, draw, item, *keep). ``users`` holds the key, the draw count
    ``m`` and any ``keep`` columns carried onto every draw. With ``first``
    the draws before that number are left out."""
    keep = list(keep)
    drivers = users.where(F.col(m_col) > first)
    n_draws = drivers.agg(F.sum(F.col(m_col) - first)).first()[0] or 0     # one small job
    placed = spread(drivers, expected_rows=int(n_draws)) if not first else drivers.repartition(
        spread_tasks(drivers, int(n_draws)))
    d = (placed.select(key, *keep, F.explode(F.sequence(F.lit(first), F.col(m_col) - 1)).alias(draw)))
    r = F.floor(uniform(seed, round_no, key, draw) * F.lit(float(table.total))).cast("bigint")
    d = d.withColumn("_r", r)
    ranges = table.ranges.select(table.item, "start", "end", "bucket")
    buckets = maybe_broadcast(ranges, known_rows=table.n_items + math.ceil(table.total / table.width))
    packs = table.packs() if buckets is ranges else None
    if packs is not None:
        last = F.size(F.filter("_starts", lambda start: start <= F.col("_r"))) - 1
        j = d.join(packs, F.floor(F.col("_r") / table.pack_width) == F.col("_pack"))
        return j.select(key, draw, F.get("_items", last).alias(table.item), *keep)
    if buckets is ranges:
        buckets = ranges.hint("shuffle_hash")
    # the bucket is worked out on either side of the exchange, not carried through it
    j = d.join(buckets, (F.floor(F.col("_r") / table.width) == F.col("bucket"))
               & (F.col("_r") >= F.col("start")) & (F.col("_r") < F.col("end")))
    return j.select(key, draw, table.item, *keep)


def _first_k(draws: DataFrame, k_col, key: str, item: str, draw: str, out: str) -> DataFrame:
    """De-duplicate draws (first occurrence) and keep the first k per user."""
    first = draws.groupBy(key, item).agg(F.min(draw).alias(draw))
    w = Window.partitionBy(key).orderBy(draw)
    return first.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k_col).drop(draw)


#: items with a waiting time of their own, and arrivals of the others, both
#: in multiples of k, for a user that is short after its draws
HEAD_FACTOR = 8
TAIL_FACTOR = 2


def _tail_items(arrivals: DataFrame, by_rank: DataFrame, table: PopularityTable, widest: int) -> DataFrame:
    """The item that each ``_r`` of the range in rank order falls on; ``widest``
    is the longest tail, which sets the buckets."""
    width = max(1, math.ceil(widest / max(1, table.n_items)))
    buckets = (by_rank.where(F.col("start") + F.col("count") > table.total - widest)
                      .withColumn("_end", F.col("start") + F.col("count"))
                      .withColumn("_bucket", F.explode(F.sequence(F.floor(F.col("start") / width),
                                                                  F.floor((F.col("_end") - 1) / width))))
                      .select(table.item, "start", "_end", "_bucket"))
    buckets = maybe_broadcast(buckets, known_rows=table.n_items + math.ceil(table.total / width))
    return (arrivals.withColumn("_bucket", F.floor(F.col("_r") / width)).join(buckets, "_bucket")
                    .where((F.col("_r") >= F.col("start")) & (F.col("_r") < F.col("_end"))))


@dataclass
class _Depths:
    short: DataFrame       # key, _have, _gone, _need, _head, _cut
    by_rank: DataFrame     # item, count, pop_rank, start
    users: int
    rows: int              # of all heads
    deepest: int
    widest: int            # the longest tail

    def ranks(self, item: str) -> DataFrame:
        return maybe_broadcast(self.by_rank.where(F.col("pop_rank") <= self.deepest).select(
            F.col("pop_rank").alias("_rank"), item, "count"), known_rows=self.deepest)


def _depths(short: DataFrame, excluded: DataFrame | None, table: PopularityTable, k: int,
            key: str) -> _Depths | None:
    """How many rows the ``short`` users (key, ``_have``) need, and where the
    head of each ends; None without any."""
    item = table.item
    if excluded is not None:
        gone = (excluded.join(short.select(key), key, "left_semi").select(key, item).distinct()
                        .join(table.ranked.select(item), item, "left_semi")
                        .groupBy(key).agg(F.count(F.lit(1)).alias("_gone")))
        short = short.join(gone, key, "left").withColumn("_gone", F.coalesce("_gone", F.lit(0)))
    else:
        short = short.withColumn("_gone", F.lit(0))
    short = short.withColumn("_need", F.least(F.lit(k), F.lit(table.n_items) - F.col("_gone")) - F.col("_have"))
    short = staged(short.where(F.col("_need") > 0).withColumn(
        "_head", F.least(F.lit(table.n_items), HEAD_FACTOR * k + F.col("_gone"))), "sampling-short")
    sizes = short.agg(F.count(F.lit(1)).alias("users"), F.sum("_head").alias("rows"),
                      F.max("_head").alias("deepest")).first()
    if not sizes["users"]:
        return None
    by_rank = staged(running_sum(table.ranked.select(item, "count", "pop_rank"), ["pop_rank"], "count",
                                 name="start"), "sampling-ranks")
    # one row for each depth of a head
    cuts = short.select("_head").distinct().join(by_rank, F.col("_head") == F.col("pop_rank")).select(
        "_head", (F.col("start") + F.col("count")).cast("bigint").alias("_cut"))
    short = staged(short.join(maybe_broadcast(cuts), "_head"), "sampling-cuts")
    widest = table.total - (short.agg(F.min("_cut")).first()[0] or 0)
    return _Depths(short, by_rank, int(sizes["users"]), int(sizes["rows"]), sizes["deepest"], widest)


def _waits(d: _Depths, table: PopularityTable, key: str, seed: int, dealt: DataFrame) -> DataFrame:
    """(key, item, ``_when``): the waiting times of the heads of ``dealt`` users."""
    return (dealt.select(*dealt.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_head").cast("bigint")))
                         .alias("_rank"))
            .join(d.ranks(table.item), "_rank")
            .withColumn("_when", -F.log(1 - uniform(seed, F.lit("head"), key, table.item)) / F.col("count")))


def _arrivals(d: _Depths, table: PopularityTable, key: str, seed: int, dealt: DataFrame, m: int) -> DataFrame:
    """(key, item, ``_when``): the first ``m`` arrivals of the tail of ``dealt`` users."""
    rate = F.lit(table.total) - F.col("_cut")
    drawn = dealt.select(key, "_cut", F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias("_draw"))
    step = -F.log(1 - uniform(seed, F.lit("step"), key, "_draw")) / rate
    # at most m rows of a user
    arrivals = drawn.withColumn("_when", F.sum(step).over(Window.partitionBy(key).orderBy("_draw"))).withColumn(
        "_r", F.col("_cut") + F.floor(uniform(seed, F.lit("tail"), key, "_draw") * rate).cast("bigint"))
    return _tail_items(arrivals, d.by_rank, table, d.widest).select(key, table.item, "_when")


def _top_up(short: DataFrame, chosen: DataFrame, excluded: DataFrame | None, table: PopularityTable,
            k: int, key: str, out: str, seed: int) -> DataFrame:
    """The missing rows (key, item, out) of ``short`` users (key, ``_have``), each
    of whom has few ``chosen`` and ``excluded`` items.

    Each user gets k items in all, or all admissible ones. A user takes
    HEAD_FACTOR * k rows and one per excluded item for the head, and
    TAIL_FACTOR * k for the arrivals; only users whose arrivals end too early,
    which is rare as an item of the tail is no more popular than any of the
    head, go on with twice as many (and the same first ones).

    Users are dealt to tasks by key, with their chosen and excluded items as
    one list, so head and arrivals are made, reduced to one row per user and
    cut to what the user needs where they are: no shuffle moves them.
    """
    item = table.item
    taken = chosen.select(key, item)
    if excluded is not None:
        taken = taken.unionByName(excluded.select(key, item))
    d = _depths(short, excluded, table, k, key)
    if d is None:
        return chosen.limit(0)
    taken = _of_keys(taken, d.short, key).groupBy(F.col(key).alias("_of_key")).agg(
        F.collect_set(item).alias("_out"))
    short = d.short.join(taken, F.col(key).eqNullSafe(F.col("_of_key")), "left").drop("_of_key")
    short = staged(short.withColumn("_out", F.coalesce("_out", F.array().cast(
        f"array<{chosen.schema[item].dataType.simpleString()}>"))), "sampling-cuts")

    def dealt(users: DataFrame, rows: int) -> DataFrame:
        return spread(users, expected_rows=rows).repartition(spread_tasks(users, rows), key)

    def free(c):
        return F.coalesce(~F.array_contains("_out", c), F.lit(True))

    pair = F.struct("_when", item)
    head = _waits(d, table, key, seed, dealt(short, d.rows)).where(free(F.col(item)))
    head = head.groupBy(key).agg(F.max("_need").alias("_most"), F.array_sort(F.collect_list(pair)).alias("_first"))
    head = head.select(F.col(key).alias("_of_key"), F.slice("_first", F.lit(1), F.col("_most").cast("int")).alias("_first"))
    short = staged(short.join(head, F.col(key).eqNullSafe(F.col("_of_key")), "left").drop("_of_key"), "sampling-head")
    none, done, m, users = short.schema["_first"].dataType.simpleString(), None, TAIL_FACTOR * k, d.users
    while True:
        tail = _arrivals(d, table, key, seed, dealt(short.where(F.lit(table.total) > F.col("_cut")).select(key, "_cut"),
                                                    users * m), m)
        tail = tail.groupBy(key, item).agg(F.min("_when").alias("_when"), F.max("_when").alias("_until"))
        tail = tail.groupBy(F.col(key).alias("_of_key")).agg(F.max("_until").alias("_until"),
                                                             F.collect_list(pair).alias("_later"))
        both = short.join(tail, F.col(key).eqNullSafe(F.col("_of_key")), "left").drop("_of_key")
        known = F.concat(F.coalesce("_first", F.array().cast(none)),
                         F.filter(F.coalesce("_later", F.array().cast(none)), lambda x: free(x[item])))
        known = F.filter(known, lambda x: F.col("_until").isNull() | (x["_when"] <= F.col("_until")))
        both = staged(both.withColumn("_known", F.slice(F.array_sort(known), F.lit(1), F.col("_need").cast("int"))).select(
            *short.columns, "_known"), "sampling-tail")
        full = F.size("_known") == F.col("_need")
        found = both.where(full).select(key, "_have", F.posexplode("_known").alias("_p", "_x")).select(
            key, F.col("_x")[item].alias(item), (F.col("_have") + F.col("_p") + 1).cast("int").alias(out))
        done = found if done is None else done.unionByName(found)
        short = both.where(~full).drop("_known")
        users = short.count()
        if not users:
            return done
        m *= 2


def _top_up_rows(short: DataFrame, chosen: DataFrame, excluded: DataFrame | None, table: PopularityTable,
                 k: int, key: str, out: str, seed: int) -> DataFrame:
    """``_top_up`` for users with any number of excluded items: these are taken
    out by anti joins, and no user's items are gathered."""
    item = table.item
    d = _depths(short, excluded, table, k, key)
    if d is None:
        return chosen.limit(0)
    short = d.short

    def admissible(rows: DataFrame) -> DataFrame:
        rows = rows.join(chosen.select(key, item), [key, item], "left_anti")
        if excluded is not None:
            rows = rows.join(excluded.select(key, item), [key, item], "left_anti")
        return rows

    head = _waits(d, table, key, seed, spread(short, expected_rows=d.rows).select(key, "_head"))
    head = staged(admissible(head.select(key, item, "_when")), "sampling-head")
    done, m = None, TAIL_FACTOR * k
    while True:
        rate = F.lit(table.total) - F.col("_cut")
        arrivals = staged(_arrivals(d, table, key, seed, spread(short.where(rate > 0), expected_rows=d.users * m), m),
                          "sampling-tail")
        ends = arrivals.groupBy(key).agg(F.max("_when").alias("_until"))
        firsts = admissible(arrivals.groupBy(key, item).agg(F.min("_when").alias("_when")))
        users = short.join(ends, key, "left").select(key, "_have", "_need", "_until")
        place = Window.partitionBy(key).orderBy("_when", item)
        known = (head.unionByName(firsts).join(users, key)
                     .where(F.col("_until").isNull() | (F.col("_when") <= F.col("_until")))
                     .withColumn("_rn", F.row_number().over(place)).where(F.col("_rn") <= F.col("_need"))
                     .withColumn("_found", F.count(F.lit(1)).over(Window.partitionBy(key))))
        known = staged(known.where(F.col("_found") == F.col("_need")).select(
            key, item, (F.col("_have") + F.col("_rn")).cast("int").alias(out)), "sampling-found")
        done = known if done is None else done.unionByName(known)
        short = staged(short.join(known.select(key).distinct(), key, "left_anti"), "sampling-short")
        if short.isEmpty():
            return done
        m *= 2


#: positives of a user that may become one array
LIST_POSITIVES = 65_536
#: draws of the first part, in multiples of k
FIRST_DRAWS = 1.25


def _first_part(k: int) -> int:
    return math.ceil(FIRST_DRAWS * k)


def _of_keys(users: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``users`` whose key (null is one, too) is in ``keys``."""
    keys = keys.select(F.col(key).alias("_of_key"))
    return users.join(keys, F.col(key).eqNullSafe(F.col("_of_key")), "left_semi")


def _complete(users: DataFrame, excluded: DataFrame, table: PopularityTable, k: int, key: str, out: str,
              seed: int) -> DataFrame:
    """The sample of every user (key, ``m``) without its ``excluded`` items, as
    rows: the first part of the draws, the others of users who are short, and
    what is still missing (``_top_up``)."""
    item, part = table.item, _first_part(k)

    def distinct(draws: DataFrame) -> DataFrame:
        return draws.join(excluded.select(key, item), [key, item], "left_anti")

    def chosen_of(draws: DataFrame) -> DataFrame:
        rows = _first_k(draws, F.lit(k), key, item, "draw", out)
        return staged(rows.select(key, item, F.col(out).cast("int").alias(out)), "sampling-chosen")

    def lacking(of: DataFrame, chosen: DataFrame) -> DataFrame:
        have = chosen.groupBy(key).agg(F.count(F.lit(1)).alias("_have")).withColumnRenamed(key, "_have_key")
        return (of.join(have, F.col(key).eqNullSafe(F.col("_have_key")), "left").drop("_have_key")
                  .withColumn("_have", F.coalesce("_have", F.lit(0))).where(F.col("_have") < k))

    head = users.withColumn("m", F.least("m", F.lit(part)))
    chosen = chosen_of(distinct(popularity_draws(head, table, seed, key)))
    short = staged(lacking(users.select(key, "m"), chosen), "sampling-few")
    if short.isEmpty():
        return chosen
    # their chosen items stand for the draws they came from, in draw order
    few = _of_keys(chosen, short, key).select(key, (F.col(out) - 1).alias("draw"), item)
    more = distinct(popularity_draws(short, table, seed, key, first=part)).select(key, "draw", item)
    again = chosen_of(few.unionByName(more))
    keys = short.select(F.col(key).alias("_of_key"))
    settled = chosen.join(keys, F.col(key).eqNullSafe(F.col("_of_key")), "left_anti")
    still = lacking(short.select(key), again)
    return settled.unionByName(again).unionByName(_top_up_rows(still, again, excluded, table, k, key, out, seed))


def _complete_arrays(gathered: DataFrame, excluded: DataFrame | None, table: PopularityTable, k: int,
                     key: str, out: str, seed: int, as_lists: bool = False) -> DataFrame:
    """Rows of ``gathered`` (key, ``_items``: at most k of every user; read from
    files), and what its short users lack; who is short is read off the arrays.
    With ``as_lists`` the items of a user stay one list."""
    item = table.item

    def rows(df: DataFrame) -> DataFrame:
        return (df.select(key, F.posexplode("_items").alias("_p", item))
                  .select(key, item, (F.col("_p") + 1).cast("int").alias(out)))

    few = gathered.where(F.size("_items") < k)
    if few.isEmpty():
        return gathered.select(key, F.col("_items").alias(item)) if as_lists else rows(gathered)
    short = few.select(key, F.size("_items").cast("bigint").alias("_have"))
    more = _top_up(short, rows(few), excluded, table, k, key, out, seed)
    if not as_lists:
        return rows(gathered).unionByName(more)
    more = more.groupBy(F.col(key).alias("_more_key")).agg(
        F.array_sort(F.collect_list(F.struct(out, item))).alias("_more"))
    joined = few.join(more, F.col(key).eqNullSafe(F.col("_more_key")), "left")
    filled = F.when(F.col("_more").isNull(), F.col("_items")).otherwise(
        F.concat("_items", F.transform("_more", lambda x: x[item])))
    return gathered.where(F.size("_items") >= k).select(key, F.col("_items").alias(item)).unionByName(
        joined.select(key, filled.alias(item)))


def sample_negatives(users: DataFrame, table: PopularityTable, k: int = 100, seed: int = 42,
                     key: str = "user_id", oversample: int = 4, out: str = "neg_rank") -> DataFrame:
    """``k`` distinct popularity-weighted items per user, positives
    allowed -> (user, item, neg_rank 1..k)."""
    u = users.select(key).withColumn("m", F.lit(oversample * k))
    return _complete_arrays(_gathered(u, None, table, k, key, seed), None, table, k, key, out, seed)


def _gathered(users: DataFrame, excluded_lists: DataFrame | None, table: PopularityTable, k: int, key: str,
              seed: int) -> DataFrame:
    """(key, ``_items``): ``_first_k_arrays`` over the first part of the draws,
    for users who are short over all their ``m`` draws."""
    item, part = table.item, _first_part(k)
    head = users.withColumn("m", F.least("m", F.lit(part)))
    got = staged(_first_k_arrays(popularity_draws(head, table, seed, key), excluded_lists, k, key, item, "draw"),
                 "sampling-first")
    few = got.where(F.size("_items") < k)
    if few.isEmpty():
        return got
    # their items stand for the draws they came from, in draw order; a user none
    # of whose draws was admissible keeps a row without an item
    items = few.select(key, F.posexplode_outer("_items").alias("draw", item))
    more = popularity_draws(_of_keys(users, few, key), table, seed, key, first=part).select(key, "draw", item)
    again = staged(_first_k_arrays(items.unionByName(more), excluded_lists, k, key, item, "draw"),
                   "sampling-again")
    return got.where(F.size("_items") >= k).unionByName(again)


def _first_k_arrays(draws: DataFrame, excluded_lists: DataFrame | None, k: int, key: str, item: str,
                    draw: str) -> DataFrame:
    """(key, ``_items``): the first ``k`` distinct admissible items per user in
    draw order with one shuffle of (user, draw, item): a user's pairs are
    gathered and sorted by draw, then the user's excluded items (one row per
    user) are taken out. Draw lists are bounded by the user's draw count."""
    g = draws.groupBy(key).agg(F.array_sort(F.collect_list(
        F.when(F.col(draw).isNotNull(), F.struct(draw, item)))).alias("_d"))
    items = F.transform("_d", lambda x: x[item])
    if excluded_lists is None:
        return g.select(key, F.slice(F.array_distinct(items), 1, k).alias("_items"))
    g = g.join(excluded_lists, key, "left")
    admissible = F.when(F.col("_pos").isNull(), F.array_distinct(items)).otherwise(
        F.array_except(items, F.col("_pos")))
    return g.select(key, F.slice(admissible, 1, k).alias("_items"))


def sample_negatives_excluding(users: DataFrame, positives: DataFrame, table: PopularityTable,
                               k: int = 100, seed: int = 42, key: str = "user_id",
                               npos_col: str = "n_pos", oversample: int = 4,
                               out: str = "neg_rank",
                               max_positives: int | None = None, as_lists: bool = False) -> DataFrame:
    """``k`` distinct weighted negatives per user, none in ``positives``.

    ``users`` has the key and ``n_pos`` (number of excluded items of that
    user); each user draws ``oversample * k + 2 * n_pos`` times. Users still
    short after de-duplication are topped up (``_top_up``), so every user gets
    exactly ``k`` when the catalogue allows.

    With ``max_positives`` (a proven bound on positives per user, such as
    the activity filter's ``hi``) each user's positives become one array, which
    meets the user's gathered draws; only (user, draw, item) is shuffled.
    Without a bound the users are counted: those with more than LIST_POSITIVES
    positives have them removed with an anti join, and the first ``k`` come
    from a per-user window. ``as_lists`` (bounded users only) returns
    (user, list of items in rank order), one row per user.
    """
    item = table.item
    if as_lists and max_positives is None:
        raise ValueError("as_lists needs max_positives")
    u = users.select(key, npos_col).withColumn("m", F.lit(oversample * k) + 2 * F.col(npos_col))
    u = staged(u, "sampling-users")

    def by_lists(u: DataFrame, positives: DataFrame) -> DataFrame:
        lists = positives.groupBy(key).agg(F.collect_set(item).alias("_pos"))
        return _complete_arrays(_gathered(u, lists, table, k, key, seed), positives, table, k, key, out, seed,
                                as_lists)

    if max_positives is not None:
        return by_lists(u, positives)
    # users with more positives, or draws for so many, than an array should hold
    many = positives.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > LIST_POSITIVES).select(key)
    many = staged(many.unionByName(u.where(F.col(npos_col) > LIST_POSITIVES).select(key)).distinct(), "sampling-many")
    if many.isEmpty():
        return by_lists(u, positives)
    keys = many.select(F.col(key).alias("_of_key"))

    def others(df: DataFrame) -> DataFrame:
        return df.join(keys, F.col(key).eqNullSafe(F.col("_of_key")), "left_anti")

    return by_lists(others(u), others(positives)).unionByName(
        _complete(_of_keys(u, many, key).select(key, "m"), _of_keys(positives, many, key), table, k, key, out, seed))
