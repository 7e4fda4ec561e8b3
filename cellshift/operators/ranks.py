"""Exact order statistics of groups of any size, by radix selection.

A double is mapped to a 64-bit integer of the same order.  For all groups and all wanted
ranks at once, rows are counted by the next 16 bits of that integer; the count that holds a
rank becomes its bracket, and so on until no bracket has more than ``BLOCK`` rows or all 64
bits are known.  Between passes only counters travel, at most 65,536 a bracket.  Then the
rows of the brackets are put in order, none of them larger than a block.  The same steps run
at every size; how many passes there are is counted, not chosen.

One rule for numbers that are none: NaN is larger than every number, infinity included, and
-0 equals 0, as in Spark's own order.  ``observed`` leaves NaN out.
"""

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellshift.session import stored

# Ship this module's functions with the plan, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 1 << 14  # most rows of a bracket that one task puts in order
_DIGIT = 16
_DEPTHS = 64 // _DIGIT
#: Fixed values of double precision: the smallest normal number, and the bits of infinity and NaN.
_SMALLEST, _INFINITE, _NAN = "2.2250738585072014E-308D", 0x7FF0 << 48, 0x7FF8 << 48


def observed(value: Column) -> Column:
    """The value as double, null for NaN."""
    x = value.cast("double")
    return F.when(~F.isnan(x), x)


def with_order_key(df: DataFrame, value: str, key: str) -> DataFrame:
    """Adds ``key``, a bigint in the order of the double ``value``.

    Exponent and mantissa are taken apart by exact divisions by powers of two; the
    logarithm may be off by one, which the next step puts right.
    """
    a = f"abs({value})"
    plain = f"NOT isnan({value}) AND {a} < double('Infinity')"
    exponent = f"CASE WHEN {plain} AND {a} >= {_SMALLEST} THEN greatest(-1022, least(1023, int(floor(log2({a}))))) ELSE -1022 END"
    mantissa = f"CASE WHEN {plain} THEN {a} / pow(2D, _e) ELSE 0D END"
    moved = "CASE WHEN _m >= 2 THEN 1 WHEN _m < 1 AND _e > -1022 THEN -1 ELSE 0 END"
    bits = (
        f"CASE WHEN isnan({value}) THEN {_NAN}L WHEN NOT ({plain}) THEN {_INFINITE}L ELSE"
        f" bigint(_e + _s + 1022) * {1 << 52}L + bigint(CASE _s WHEN 1 THEN _m / 2 WHEN -1 THEN _m * 2 ELSE _m END * {1 << 52}D) END"
    )
    return (
        df.withColumn("_e", F.expr(exponent))
        .withColumn("_m", F.expr(mantissa))
        .withColumn("_s", F.expr(moved))
        .withColumn("_bits", F.expr(bits))
        .withColumn(key, F.expr(f"CASE WHEN {value} < 0 THEN -_bits ELSE _bits END"))
        .drop("_e", "_m", "_s", "_bits")
    )


def _prefix(key: str, depth: int, digit: int = _DIGIT) -> Column:
    """The first ``depth`` digits of the key, in order; nothing is 0."""
    return F.shiftright(key, 64 - digit * depth) if depth else F.lit(0).cast("bigint")


def _holding(asks: DataFrame, counted: DataFrame, keys: list[str], depth: int) -> DataFrame:
    """The asks moved into the one of the counted digits (``keys, prefix, next, rows``) that holds their rank."""
    upto = F.sum("rows").over(Window.partitionBy(*keys, "prefix").orderBy("next"))
    hit = (F.col("local") < F.col("upto")) & (F.col("local") >= F.col("upto") - F.col("rows"))
    return (
        asks.join(counted.withColumn("upto", upto), [*keys, "prefix"])
        .where(hit)
        .select(
            *keys, "rank", F.lit(depth + 1).alias("depth"), F.col("next").alias("prefix"),
            (F.col("local") - F.col("upto") + F.col("rows")).alias("local"), F.col("rows").alias("n"),
        )
    )


def _asks(keys: list[str], wanted: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return (
        wanted.where("rank >= 0 AND rank < n")
        .select(*keys, F.col("rank").cast("bigint").alias("rank"), F.lit(0).alias("depth"), zero.alias("prefix"),
                F.col("rank").cast("bigint").alias("local"), F.col("n").cast("bigint").alias("n"))
        .distinct()
    )


def _open(depth: int, most: int) -> Column:
    return (F.col("depth") == depth) & (F.col("n") > most)


def values(df: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """A stored table of ``keys`` and ``v``, the values that are not null, as doubles."""
    rows = df.select(*keys, value.cast("double").alias("v")).where("v IS NOT NULL")
    return stored(rows, "values")


def sizes(data: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` and ``n``, the number of values of each group that has any."""
    return data.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def at_ranks(data: DataFrame, keys: Sequence[str], wanted: DataFrame) -> DataFrame:
    """The value at each wanted rank: ``keys, rank, value``.

    ``data`` is what ``values`` gave, with keys that are not null.  ``wanted`` holds ``keys,
    rank, n``: ranks from 0, below the group's number of values ``n``; others are left out.
    """
    keys = list(keys)
    asks = _asks(keys, wanted)
    keyed, depth = with_order_key(data, "v", "_key"), 0
    while depth < _DEPTHS and not asks.where(_open(depth, BLOCK)).isEmpty():
        asks = stored(_narrowed(keyed, keys, asks, depth), "ranks")
        depth += 1
    return asks.join(_in_order(keyed, keys, asks, depth), [*keys, "depth", "prefix"]).select(
        *keys, "rank", F.when(F.col("depth") == _DEPTHS, F.col("_vs")[0]).otherwise(F.get("_vs", F.col("local").cast("int"))).alias("value")
    )


def _narrowed(keyed: DataFrame, keys: list[str], asks: DataFrame, depth: int) -> DataFrame:
    """The asks with one more digit where the bracket was too large."""
    wide = asks.where(_open(depth, BLOCK))
    brackets = wide.select(*keys, "prefix").distinct()
    counted = (
        keyed.select(*keys, _prefix("_key", depth).alias("prefix"), _prefix("_key", depth + 1).alias("next"))
        .join(brackets, [*keys, "prefix"])
        .groupBy(*keys, "prefix", "next")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return asks.where(~_open(depth, BLOCK)).unionByName(_holding(wide, counted, keys, depth))


def _in_order(keyed: DataFrame, keys: list[str], asks: DataFrame, deepest: int) -> DataFrame:
    """``keys, depth, prefix`` and the sorted values of each bracket; of one whose bits are all known, any value."""
    at = F.array(
        *[F.struct(F.lit(d).alias("depth"), _prefix("_key", d).alias("prefix")) for d in range(deepest + 1)]
    )
    brackets = asks.select(*keys, "depth", "prefix").distinct()
    found = keyed.select(*keys, "v", F.inline(at)).join(brackets, [*keys, "depth", "prefix"])
    known = F.col("depth") == _DEPTHS
    return found.groupBy(*keys, "depth", "prefix").agg(
        F.sort_array(F.collect_list(F.when(~known, F.col("v")))).alias("_list"), F.max(F.when(known, F.col("v"))).alias("_one")
    ).select(*keys, "depth", "prefix", F.when(known, F.array("_one")).otherwise(F.col("_list")).alias("_vs"))


def percentiles(
    data: DataFrame, keys: Sequence[str], probabilities: Sequence[float], names: Sequence[str]
) -> DataFrame:
    """``keys, n`` and a column per probability, by linear interpolation, for groups with values.

    ``data`` is what ``values`` gave.
    """
    keys = list(keys)
    counted = sizes(data, keys)
    targets = [F.lit(float(p)) * (F.col("n") - 1) for p in probabilities]
    ends = [c.cast("bigint") for t in targets for c in (F.floor(t), F.ceil(t))]
    wanted = counted.select(*keys, "n", F.explode(F.array_distinct(F.array(*ends))).alias("rank"))
    found = (
        at_ranks(data, keys, wanted)
        .groupBy(*keys)
        .agg(F.map_from_entries(F.collect_list(F.struct("rank", "value"))).alias("_at"))
    )
    out = []
    for target, name in zip(targets, names):
        low = F.col("_at")[F.floor(target).cast("bigint")]
        high = F.col("_at")[F.ceil(target).cast("bigint")]
        # no arithmetic between equal ends: infinity less infinity is no number
        between = F.when(low == high, low).otherwise(low + (target - F.floor(target)) * (high - low))
        out.append(between.alias(name))
    return counted.join(found, keys).select(*keys, "n", *out)


# --- unions of shared classes --------------------------------------------------

#: Bits of the order key that are known after each pass: sign and exponent, then 8 more a pass,
#: so that a class and bracket have 256 counters at most, whatever the classes' size.
_KNOWN = (0, 12, 20, 28, 36, 44, 52, 60, 64)
_COUNTED = 2  # passes that work on counters of the first bits; later ones read the brackets' own rows
_FEW = 64  # a bracket of so many values is read


def at_ranks_of_unions(
    shared: DataFrame, members: DataFrame, own: DataFrame, keys: Sequence[str], wanted: DataFrame
) -> DataFrame:
    """The value at each wanted rank of unions of shared classes, changed a little: ``keys, rank, value``.

    ``shared`` (cid, v, n) counts the values of every class, ``members`` (keys, cid) says whose
    union a key stands for, ``own`` (keys, v, n) what it has more of or, below 0, less of; a
    value may come in several rows, and with its order key ``_key``.  ``wanted`` has ``keys, rank, n`` as in ``at_ranks``.

    Keys of the same classes share one union, and a union's bracket is counted once for all of
    them: its counters are one row, which meets an asked rank and is put together with the
    key's own there.  ``own`` is read twice: for counters of its first bits, and for the rows
    of the brackets that these leave.
    """
    keys, deepest = list(keys), len(_KNOWN) - 1
    shared = stored(with_order_key(shared, "v", "_key"), "shared")
    own = own if "_key" in own.columns else with_order_key(own, "v", "_key")
    listed = stored(members.groupBy(*keys).agg(F.sort_array(F.collect_list("cid")).alias("_cids")), "listed")
    unions = stored(listed.select("_cids").distinct().withColumn("uid", F.monotonically_increasing_id()), "unions")
    of = listed.join(unions, "_cids").select(*keys, "uid")
    classes = unions.select("uid", F.explode("_cids").alias("cid"))
    asks = stored(_asks(keys, wanted).join(of, keys, "left"), "asks")
    first = _first_bits("_key", _KNOWN[_COUNTED]).alias("first")
    counters = own.groupBy(*keys, first).agg(F.sum("n").alias("n")).where("n <> 0")
    counters, near, depth = stored(counters, "own-counters"), None, 0
    while depth < deepest and not asks.where(_open(depth, _FEW)).isEmpty():
        wide = asks.where(_open(depth, _FEW))
        if depth == _COUNTED:
            near = _near(own, keys, asks)
        bits, more = _KNOWN[depth], _KNOWN[depth + 1]
        if depth < _COUNTED:
            known = _KNOWN[_COUNTED]
            mine = counters.select(*keys, _cut("first", known - bits, bits).alias("prefix"), F.shiftright("first", known - more).alias("at"), "n")
        else:
            mine = near.select(*keys, *_digits(bits, more), "n")
        mine = mine.join(wide.select(*keys, "prefix").distinct(), [*keys, "prefix"])
        theirs = _of_unions(shared.select("cid", *_digits(bits, more), "n"), classes, wide.select("uid", "prefix"), ["prefix"])
        hit = _hits(wide, theirs, mine, keys, ["prefix"], "bigint").where("hit.at IS NOT NULL")
        moved = hit.select(
            *keys, "rank", F.lit(depth + 1).alias("depth"), F.col("hit.at").alias("prefix"),
            (F.col("local") - F.col("hit.before")).alias("local"), F.col("hit.n").alias("n"), "uid",
        )
        asks = stored(asks.where(~_open(depth, _FEW)).unionByName(moved), "ranks")
        depth += 1
    return _of_few(shared, classes, _near(own, keys, asks) if near is None else near, keys, asks, depth)


def _first_bits(key: str, bits: int) -> Column:
    """The first ``bits`` bits of the key, in order; nothing is 0."""
    return _cut(key, 64 - bits, bits)


def _cut(name: str, by: int, left: int) -> Column:
    return F.shiftright(name, by) if left else F.lit(0).cast("bigint")


def _digits(bits: int, more: int) -> tuple[Column, Column]:
    return _first_bits("_key", bits).alias("prefix"), _first_bits("_key", more).alias("at")


def _places(depths: int) -> Column:
    """A row's bracket at each of the first depths."""
    return F.array(*[F.struct(F.lit(d).alias("depth"), _first_bits("_key", _KNOWN[d]).alias("prefix")) for d in range(depths)])


def _near(own: DataFrame, keys: list[str], asks: DataFrame) -> DataFrame:
    """The rows of ``own`` in a bracket that is asked for, or was when its first bits were counted."""
    places = asks.groupBy(*keys).agg(F.collect_set(F.struct("depth", "prefix")).alias("_asked"))
    near = own.join(places, keys).where(F.arrays_overlap("_asked", _places(_COUNTED + 1)))
    return stored(near.groupBy(*keys, "v", "_key").agg(F.sum("n").alias("n")).where("n <> 0"), "near")


def _of_unions(rows: DataFrame, classes: DataFrame, brackets: DataFrame, place: list[str]) -> DataFrame:
    """``uid``, ``place`` and ``us``: the counts by ``at`` of each of the unions' brackets."""
    brackets = brackets.distinct().join(classes, "uid")
    per_class = (
        rows.join(brackets.select("cid", *place).distinct(), ["cid", *place])
        .groupBy("cid", *place, "at")
        .agg(F.sum("n").alias("n"))
    )
    return (
        brackets.join(per_class, ["cid", *place])
        .groupBy("uid", *place, "at")
        .agg(F.sum("n").alias("n"))
        .groupBy("uid", *place)
        .agg(F.collect_list(F.struct("at", "n")).alias("us"))
    )


def _hits(asks: DataFrame, theirs: DataFrame, mine: DataFrame, keys: list[str], place: list[str], kind: str) -> DataFrame:
    """The asks with ``hit``: the ``at`` that holds their rank, its ``n`` and the number ``before`` it.

    An ask outside of the counted ones is left out.
    """
    own = (
        mine.groupBy(*keys, *place, "at")
        .agg(F.sum("n").alias("n"))
        .where("n <> 0")
        .groupBy(*keys, *place)
        .agg(F.collect_list(F.struct("at", "n")).alias("os"))
    )
    met = asks.join(theirs, ["uid", *place], "left").join(own, [*keys, *place], "left")
    # few bytes, and much to add up for each ask
    tasks = int(asks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.repartition(tasks, *keys, "rank")
    return met.select(*asks.columns, _located(kind)("us", "os", "local").alias("hit")).where("hit IS NOT NULL")


def _located(kind: str):
    """A column function: where in two lists of counts, taken as one, a rank falls; null outside of them."""

    @F.arrow_udf(f"struct<at: {kind}, n: bigint, before: bigint>")
    def located(us: pa.Array, os: pa.Array, local: pa.Array) -> pa.Array:
        sizes = [pa.compute.fill_null(pa.compute.list_value_length(x), 0).to_numpy(zero_copy_only=False) for x in (us, os)]
        flat = pa.concat_arrays([us.flatten(), os.flatten()])
        at, n = flat.field("at"), flat.field("n").to_numpy(zero_copy_only=False)
        row = np.concatenate([np.repeat(np.arange(len(us)), x) for x in sizes])
        known = at.is_valid().to_numpy(zero_copy_only=False)
        value = at.fill_null(0).to_numpy(zero_copy_only=False)
        order = np.lexsort((value, known, row))  # nulls first, NaN last
        row, known, value, n = row[order], known[order], value[order], n[order]
        alike = (value[1:] == value[:-1]) | ((value[1:] != value[1:]) & (value[:-1] != value[:-1]))
        alike &= (row[1:] == row[:-1]) & (known[1:] == known[:-1])
        starts = np.flatnonzero(np.concatenate([np.ones(min(len(row), 1), bool), ~alike]))
        counts, row = np.add.reduceat(n, starts) if len(starts) else n, row[starts]
        upto = np.cumsum(counts)
        first = np.searchsorted(row, row)  # a row's own first group
        upto = upto - (upto - counts)[first]
        rank = local.to_numpy(zero_copy_only=False)
        rows, hit = np.unique(row[upto > rank[row]], return_index=True)
        hit = np.flatnonzero(upto > rank[row])[hit]
        place = np.full(len(us), -1)
        place[rows] = hit
        taken = pa.array(np.maximum(place, 0), mask=place < 0)
        columns = (at.take(pa.array(order[starts])), pa.array(counts), pa.array(upto - counts))
        return pa.StructArray.from_arrays(
            [c.take(taken) for c in columns], names=["at", "n", "before"], mask=pa.array(place < 0)
        )

    return located


def _of_few(shared: DataFrame, classes: DataFrame, near: DataFrame, keys: list[str], asks: DataFrame, deepest: int) -> DataFrame:
    """The values at the asks' ranks, from the few rows of their brackets."""
    place = ["depth", "prefix"]
    at = F.inline(_places(deepest + 1))
    theirs = _of_unions(shared.select("cid", F.col("v").alias("at"), "n", at), classes, asks.select("uid", *place), place)
    mine = near.select(*keys, F.col("v").alias("at"), "n", at).join(asks.select(*keys, *place).distinct(), [*keys, *place])
    return _hits(asks, theirs, mine, keys, place, "double").select(*keys, "rank", F.col("hit.at").alias("value"))
