"""Ordered computations over a whole log without a single-partition window.

``running_total`` and ``carry_forward`` are what every position, segment, history and conflict operator
is made of. Both split the log by *ranges of its total order*, so one transaction, source or row key may hold any
share of the records without one task holding them all.

A range is a bucket: a function of the order columns alone (``add_buckets``). Its bounds come from one aggregate of
bounded size over those columns. Nothing else runs before the action, nothing is kept or checkpointed, and a row that is
computed again after an executor is lost lands in the bucket it was in.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import durable, shuffle_width

HOT_ROWS = 1_000_000
"""Rows of one key beyond which the key is split over several tasks."""

SENT_KEYS = 1_000_000
"""Busy keys that are sent to every task as hashes of 8 bytes; at ``HOT_ROWS`` that many take 10^12 rows."""

BUCKETS_PER_TASK = 4
"""Buckets for each shuffle partition, so that uneven ones even out."""

SAMPLES_PER_BUCKET = 16
"""Places of the order that are looked at for each bucket."""


def bucket_count(df: DataFrame, buckets: int | None = None) -> int:
    """How many buckets ``add_buckets`` makes at most."""
    return buckets or BUCKETS_PER_TASK * shuffle_width(df)


def add_buckets(df: DataFrame, order: Sequence[Column], buckets: int | None = None, name: str = "_bucket") -> DataFrame:
    """Add the number of each row's bucket: ranges of ``order`` with about as many distinct places each, from 0.

    Of the places, hashed into a fixed number of groups, each group's smallest hash is picked: a sample that depends on
    the places alone and that partial aggregation keeps at its size. Every few of the picked ones in order is a bound; a
    row finds its bucket by bisection. Rows of one place share a bucket.
    """
    n = bucket_count(df, buckets)
    place = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    picked = (df.select(place.alias("place")).groupBy(F.pmod(F.xxhash64("place"), F.lit(n * SAMPLES_PER_BUCKET)).alias("g"))
              .agg(F.min(F.struct(F.xxhash64(F.lit(1), "place").alias("h"), "place")).alias("least")))
    sample = picked.agg(F.sort_array(F.collect_list("least.place")).alias("all"))
    step = F.greatest(F.ceil(F.size("all") / n), F.lit(1))
    bounds = sample.select(F.filter("all", lambda p, i: (i + 1) % step == 0).alias("bounds"))
    return add_places(df, order, bounds, name)


def add_places(df: DataFrame, order: Sequence[Column], bounds: DataFrame, name: str) -> DataFrame:
    """Add how many of the ``bounds`` are at or before each row: one row, an array of places of ``order`` in order.

    There must be few of them, for they become part of the plan.
    """
    place = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    # as a literal, which no row carries along; cut fractions would do no harm, bounds are any places in order
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    found = bounds.select(F.to_json("bounds", options)).first()[0]
    kind = bounds.schema["bounds"].dataType
    listed = json.loads(found)
    # Each step of the bisection is a column of its own, made of plain expressions, which become generated code (a lambda
    # over the steps is interpreted for every row). A step knows the bounds it may meet, so that all of them are there once.
    placed = df.withColumns({"_place": place, "_low": F.lit(0)})
    for k in reversed(range(len(listed).bit_length())):
        low = F.col("_low")
        met = F.from_json(F.lit(json.dumps(listed[(1 << k) - 1::2 << k])), kind, options)
        placed = placed.withColumn("_low", F.when(
            F.get(met, F.shiftright(low, k + 1)) <= F.col("_place"), low + (1 << k)).otherwise(low))
    return placed.withColumn(name, F.col("_low")).drop("_place", "_low")


def running_total(
    df: DataFrame,
    order: Sequence[Column],
    totals: Mapping[str, Column],
    buckets: int | None = None,
) -> DataFrame:
    """Add inclusive running sums of bigint expressions over the total ``order``.

    Buckets are summed, the sums (one row each) are accumulated into the total at which each bucket starts, and the
    rows of each bucket are summed up from there in a window of their own. The rows are computed and shuffled once.
    """
    names = list(totals)
    weighted = df.withColumns({n: F.coalesce(e.cast("long"), F.lit(0).cast("long")) for n, e in totals.items()})
    dealt = add_buckets(weighted, order, buckets).repartition("_bucket")
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # the sums read every column, for then both sides of the join are one shuffle, written once and read twice
    every = F.bit_xor(F.xxhash64(*weighted.columns)).alias("_every")
    starts = (
        dealt.groupBy("_bucket").agg(every, *[F.sum(n).alias(n) for n in names]).filter(F.col("_every").isNotNull())
        .select(F.col("_bucket").alias("_start_bucket"),
                *[F.coalesce(F.sum(n).over(before), F.lit(0).cast("long")).alias(f"_start_{n}") for n in names])
    )
    within = Window.partitionBy("_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kept = [c for c in weighted.columns if c not in names]
    summed = dealt.select("_bucket", *kept, *[F.sum(n).over(within).alias(n) for n in names])
    # so do the rows, whatever the caller reads of them: this holds for all of them, and is not moved below the window
    summed = summed.filter(F.xxhash64(*kept) >= -(1 << 63))
    # one row per bucket, so the broadcast does not grow with the log; null-safe, as another comparison would put a filter
    # on the bucket below one side's shuffle alone
    return summed.join(F.broadcast(starts), F.col("_bucket").eqNullSafe(F.col("_start_bucket"))).select(
        *kept, *[(F.col(n) + F.col(f"_start_{n}")).alias(n) for n in names])


def numbered(df: DataFrame, order: Sequence[Column], name: str = "pos", buckets: int | None = None) -> DataFrame:
    """Number the rows 1, 2, … in the total ``order``."""
    return running_total(df, order, {name: F.lit(1)}, buckets)


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame:
    """Hashes (``h``) of the keys with ``hot_rows`` rows or more, counted exactly; at most one for each ``hot_rows`` rows.

    The counts combine before the shuffle and stay a table, however many keys there are.
    """
    if hot_rows <= 0:
        raise ValueError("hot_rows must be positive")
    counted = df.select(F.xxhash64(*keys).alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    return durable(counted.filter(F.col("n") >= hot_rows).select("h"))


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    values: Mapping[str, Column],
    strict: bool = False,
    hot_rows: int = HOT_ROWS,
    hot: DataFrame | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Add, per key, the last non-null of each value up to each row (``strict``: before it).

    Keys of ordinary size use one window. A key above ``hot_rows`` is cut into buckets of its order;
    each bucket carries within itself and takes what precedes it from the ends of the earlier ones. ``hot``
    takes the result of an earlier ``hot_keys`` on the same keys.
    """
    names = list(values)
    staged = df.withColumns(dict(values))
    frame = (Window.unboundedPreceding, -1 if strict else Window.currentRow)
    per_key = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*frame)

    def carried(window) -> list[Column]:
        return [F.last(n, ignorenulls=True).over(window).alias(n) for n in names]

    kept = [c for c in staged.columns if c not in names]
    if hot is None:
        hot = hot_keys(df, keys, hot_rows)
    n_hot = hot.count()
    if not n_hot:
        return staged.select(*kept, *carried(per_key))

    # shuffled by its hash, a busy key would meet in one task whole; only a table of very many keys is left to Spark
    if n_hot <= SENT_KEYS:
        hot = F.broadcast(hot)
    is_hot = F.xxhash64(*keys) == F.col("h")
    cold = staged.join(hot, is_hot, "left_anti").select(*kept, *carried(per_key))

    # buckets of the busy keys' own order; each row also belongs to its key, so a bucket may hold several
    dealt = add_buckets(staged.join(hot, is_hot, "left_semi"), [*[F.col(k) for k in keys], *order], buckets)
    in_bucket = Window.partitionBy("_bucket", *keys).orderBy(*order).rowsBetween(*frame)
    key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    place = F.struct(key.alias("key"), *[o.alias(f"o{i}") for i, o in enumerate(order)])
    # what a bucket hands on: the last value of its last key, which is the only one that may go on in the next
    ends = dealt.groupBy("_bucket").agg(
        *[F.max_by(F.struct(key.alias("key"), F.col(n).alias("v")), F.when(F.col(n).isNotNull(), place)).alias(n) for n in names])
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket
    starts = ends.select(F.col("_bucket").alias("_start_bucket"),
                         *[F.last(n, ignorenulls=True).over(earlier).alias(f"_start_{n}") for n in names])
    local = dealt.select("_bucket", *kept, *carried(in_bucket))
    split = local.join(F.broadcast(starts), F.col("_bucket") == F.col("_start_bucket")).select(
        *kept, *[F.coalesce(n, F.when(F.col(f"_start_{n}.key").eqNullSafe(key), F.col(f"_start_{n}.v"))).alias(n) for n in names])
    return cold.unionByName(split)
