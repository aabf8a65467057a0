"""Operator 3: document fingerprints by Order MinHash, in DataFrame functions.

A text's units are its words, cut every UNIT characters, so that text without
spaces has units too. Its k-mers are runs of K units, shorter at the text's
end; a k-mer's occurrence number tells repeats apart. One hash orders all numbered k-mers and
the BINS permutations are that order begun at BINS evenly spaced points of the
hash range, going round its end. Under each, the L smallest of the whole text
are taken, put back into text order, and hashed as a tuple together with the
permutation's number. The list of these hashes is the signature: it changes
when k-mers change and also when they change places, as edit distance does.
The likeness of two signatures is the share of permutations that agree.

No Python, no explode and no shuffle: one array expression per text.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recprep.llm.common import let, staged

UNIT = 4
K = 2
L = 2
BINS = 64
RANGES_PER_TASK = 4

#: layout of a numbered k-mer: 6 bits bin, 33 bits hash, 24 bits place
_PLACE_BITS, _BIN_BITS = 24, 6
_PLACE = (1 << _PLACE_BITS) - 1
_HEAD_BITS = 63 - _PLACE_BITS
#: signature entries keep the bin in their top bits
_ENTRY = (1 << (63 - _BIN_BITS)) - 1


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, 63 - _BIN_BITS)


def _head(h: Column, place: Column) -> Column:
    """The hash's top bits and the place in one non-negative long."""
    return F.shiftleft(F.shiftrightunsigned(h, 64 - _HEAD_BITS), _PLACE_BITS).bitwiseOR(
        place.cast("long").bitwiseAND(F.lit(_PLACE)))


def _numbered(sorted_heads: Column) -> Column:
    """Sorted heads with repeats numbered: the first of equal hashes stays, the
    o-th after it gets the hash of (hash, o). Repeats have neighbouring places
    in the sorted list, so a gap between repeats begins a new run; the work is
    linear in their number."""
    def same(s: Column, i: Column) -> Column:
        return F.shiftrightunsigned(F.get(s, i).bitwiseXOR(F.get(s, i - 1)), _PLACE_BITS) == 0

    def of(s: Column) -> Column:
        def repeats(d: Column) -> Column:
            begins = F.filter(F.sequence(F.lit(0), F.size(d) - 1),
                              lambda j: F.coalesce(F.get(d, j) - F.get(d, j - 1) > 1, F.lit(True)))

            def numbered(b: Column) -> Column:
                return F.flatten(F.transform(b, lambda at, r: F.transform(
                    F.sequence(at, F.coalesce(F.get(b, r + 1), F.size(d)) - 1),
                    lambda j: let(F.get(s, F.get(d, j)), lambda x: _head(
                        F.xxhash64(F.shiftrightunsigned(x, _PLACE_BITS), j - at + 1),
                        x.bitwiseAND(F.lit(_PLACE)))))))
            return let(begins, numbered)

        firsts = F.filter(s, lambda x, i: F.coalesce(~same(s, i), F.lit(True)))
        again = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.coalesce(same(s, i), F.lit(False)))
        return F.concat(firsts, let(again, lambda d: F.when(F.size(d) == 0, F.array().cast("array<bigint>"))
                                    .otherwise(repeats(d))))
    return let(sorted_heads, of)


def _entries(sorted_heads: Column) -> Column:
    """Per permutation, the L smallest of the whole text in text order, hashed
    as a tuple. Permutation j reads the circle of hashes from j / BINS on, so
    its smallest are the next L heads there, beyond the end from the start."""
    def of(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.coalesce(
            _bin(F.get(s, i).bitwiseXOR(F.get(s, i - 1))) != 0, F.lit(True)))

        def entry(i: Column) -> Column:
            some = F.transform(F.sequence(F.lit(0), F.least(F.lit(L), F.size(s)) - 1),
                               lambda o: F.get(s, (i + o) % F.size(s)))
            placed = F.sort_array(F.transform(some, lambda x: F.struct(
                x.bitwiseAND(F.lit(_PLACE)).alias("p"), F.shiftrightunsigned(x, _PLACE_BITS).alias("h"))))
            return F.xxhash64(F.transform(placed, lambda x: x["h"])).bitwiseAND(F.lit(_ENTRY))

        def numbered(first: Column, last: Column, value: Column) -> Column:
            return F.when(first > last, F.array().cast("array<bigint>")).otherwise(F.transform(
                F.sequence(first, last), lambda j: F.shiftleft(j, 63 - _BIN_BITS).bitwiseOR(value)))

        def spread(at: Column) -> Column:
            # a start serves the permutations after the bin before it, up to its own bin
            each = F.transform(at, lambda i, t: let(entry(i), lambda value: numbered(
                F.coalesce(_bin(F.get(s, F.get(at, t - 1))) + 1, F.lit(0).cast("bigint")), _bin(F.get(s, i)), value)))
            rest = let(entry(F.lit(0)), lambda value: numbered(
                _bin(F.get(s, F.size(s) - 1)) + 1, F.lit(BINS - 1).cast("bigint"), value))
            return F.flatten(F.concat(each, F.array(rest)))
        return let(starts, spread)
    return let(sorted_heads, of)


def signature(text: Column) -> Column:
    """The signature of a text as array<long>; empty for a text without units."""
    units = F.regexp_extract_all(text, F.lit(rf"\S{{1,{UNIT}}}"), F.lit(0))

    def whole(h: Column) -> Column:
        # the last K - 1 k-mers end with the text
        kmers = F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, K)]))
        heads = let(kmers, lambda k: let(F.sort_array(F.transform(k, _head)), lambda s: F.when(
            F.size(F.array_distinct(k)) == F.size(k), s).otherwise(F.sort_array(_numbered(s)))))
        return F.when(F.size(h) == 0, F.array().cast("array<bigint>")).otherwise(_entries(heads))

    return let(F.transform(units, lambda w: F.xxhash64(w)), whole)


def likeness(a: Column, b: Column) -> Column:
    """Share of the permutations that agree; an empty signature agrees with
    empty ones only."""
    bins = F.size(F.array_union(F.transform(a, _bin), F.transform(b, _bin)))
    return F.when(bins == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / bins)


def as_text(sig: Column) -> Column:
    """A signature as hex digits, 16 for each entry."""
    return F.array_join(F.transform(sig, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def fingerprints(df: DataFrame, text_col: str = "text", out_col: str = "fingerprint") -> DataFrame:
    """Append the fingerprint string of each whole text. Null counts as empty,
    and an empty text has the empty fingerprint; equal texts have equal ones."""
    return df.withColumn(out_col, as_text(signature(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))))


def _bounds(keys: DataFrame, ranges: int) -> list:
    """About ``ranges`` real keys at even distances, and the greatest, in order
    (as JSON values): taken from the keys alone, sorted over all tasks."""
    step = max(1, keys.count() // ranges)
    placed = keys.repartitionByRange("key").sortWithinPartitions("key").select(
        "key", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    picks = placed.where(F.col("at") % step == step - 1).select("key").union(keys.agg(F.max("key").alias("key")))
    found = picks.where("key is not null").agg(F.to_json(F.array_sort(F.collect_set("key"))).alias("b")).first()
    return json.loads(found["b"] or "[]")


def with_next(df: DataFrame, id_col: str, text_col: str, make_columns) -> DataFrame:
    """(id, text, sig, next_text, next_sig): every row with the next one in
    descending order of id, after the last the first; rows of one id go by a
    hash of their text, null ids come last.

    One shuffle of the texts: keys (id, hash) are dealt to ranges whose upper
    bounds are real keys, and a bound's row also goes, as a copy, to the end of
    the range above (the greatest key's to the end of the lowest range), where
    it is only looked at. An id that many rows share is cut by the hash; only
    repeated rows stay together.
    """
    spark = df.sparkSession
    src = df.select(F.col(f"`{id_col}`").alias("id"),
                    F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).withColumn(
        "key", F.struct("id", F.xxhash64("text").alias("h")))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions")) * 2
    keys = staged(src.select("key"), "next-keys")
    upper = _bounds(keys, RANGES_PER_TASK * tasks)    # so that hashing them to tasks comes out even
    kind = f"array<{src.schema['key'].dataType.simpleString()}>"
    # one literal each, however many bounds there are
    literal = lambda some: F.from_json(F.lit(json.dumps(some)), kind)
    # the number of bounds below the key, found in two steps: ranges are (bound before, bound]
    step = math.isqrt(len(upper)) + 1
    below = lambda a: F.size(F.filter(a, lambda u: u < F.col("key")))
    own = let(F.greatest(below(literal(upper[::step])) - 1, F.lit(0)) * step,
              lambda at: at + below(F.slice(literal(upper), at + 1, F.lit(step))))
    ranged = src.withColumn("own", own)
    above = F.when(F.col("own") == len(upper) - 1, F.lit(0)).otherwise(F.col("own") + 1)
    mine = F.struct(F.col("own").alias("range"), F.lit(False).alias("copy"))
    places = F.when(F.get(literal(upper), F.col("own")) == F.col("key"), F.array(
        mine, F.struct(above.alias("range"), F.lit(True).alias("copy")))).otherwise(F.array(mine))
    dealt = (ranged.withColumn("place", F.explode(places)).select("id", "text", "key", "place.range", "place.copy")
                   .repartition(tasks, "range"))
    dealt = make_columns(dealt)
    order = Window.partitionBy("range").orderBy("copy", F.col("key").desc(), "text")
    return dealt.withColumn("next_text", F.lead("text").over(order)).withColumn(
        "next_sig", F.lead("sig").over(order)).where("not copy")


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text: the last third (by
    code points, rounded down) replaced by as many first code points of the
    next document, or all it has; next is by descending id, ties by a hash of
    the text, null ids last, and after the last row the first.

    Columns: the id, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``. Null text counts as
    empty; the only row of a table follows itself. Repeated rows are kept; other
    columns are ignored.
    """
    rows = with_next(df, id_col, text_col, lambda d: d.withColumn("sig", signature(F.col("text"))))
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    rows = rows.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), n - cut),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), cut)))
    out = rows.withColumn("esig", signature(F.col("edited")))
    nothing = F.array().cast("array<bigint>")
    return out.select(
        F.col("id").alias(id_col), n.cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("sig")).alias("fingerprint"), as_text(F.col("esig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("esig")).alias("near_edited"),
        likeness(F.col("sig"), F.coalesce("next_sig", nothing)).alias("near_next"))
