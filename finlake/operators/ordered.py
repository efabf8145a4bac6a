"""Ordered computations per key that never need a whole key in one task.

A plain ``Window.partitionBy(key)`` puts one key in one task, and Spark re-reads the frame for every
row of a sliding or forward-looking frame. Here time (or a sequence number) is cut into slots. Slots
are summarised with map-side combine, the small summaries are scanned per key, and what enters a
slot from its neighbours is added to it as one extra row. Rows are then handled per (key, slot)
with running frames only, so the work is n log n and a hot key spreads over all its slots.

Rows that share key and time are combined first wherever ties count as one frame position.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY, HOUR, SECOND = timedelta(days=1), timedelta(hours=1), timedelta(seconds=1)


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def _slot(position: Column, width: int) -> Column:
    """Start of the slot a position lies in."""
    return position - F.pmod(position, F.lit(width))


def _running(partition: Sequence[str], *order: Column):
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before(partition: Sequence[str], *order: Column):
    return Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def _ticks(df: DataFrame, key: str, ts: str, value: str, counted: Column | None = None) -> DataFrame:
    """One row per key and time, of the rows that have both and are counted."""
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    return (
        df.where(known if counted is None else known & counted)
        .groupBy(F.col(key).alias("k"), F.unix_micros(F.col(ts)).alias("us"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count(value).alias("nv"),
            F.sum(value).alias("s"),
            F.min(value).alias("lo"),
            F.max(value).alias("hi"),
        )
    )


def _attach(df: DataFrame, stats: DataFrame, key: str, ts: str) -> DataFrame:
    """Left join on key and time; AQE splits a (key, time) pair that many rows share. Without either there is no match."""
    rows = df.withColumn("us", F.unix_micros(F.col(ts)))
    return rows.join(stats.withColumnRenamed("k", key), [key, "us"], "left").drop("us")


def _point(kind: str, slot: Column, pos: Column, measures: Sequence[str]) -> Column:
    return F.struct(
        slot.alias("slot"), pos.alias("pos"), F.lit(kind).alias("kind"), *[F.col(c) for c in measures]
    )


def _typed(df: DataFrame, value: str) -> tuple[Column, Column]:
    """Sum and mean from the columns ``s`` and ``nv``, in the types of Spark's own aggregates of ``value``."""
    plain = df.agg(F.sum(value).alias("sum"), F.avg(value).alias("avg")).schema
    total = F.col("s").cast(plain["sum"].dataType)
    return total, F.when(F.col("nv") > 0, total / F.col("nv")).cast(plain["avg"].dataType)


def rolling_stats(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    width: timedelta,
    *,
    open_start: bool = False,
    slots: int = 360,
    counted: Column | None = None,
    prefix: str = "",
) -> DataFrame:
    """Count, sum, mean, min and max of ``value`` over ``[t - width, t]`` for every row.

    Rows with equal time are all inside each other's frame; rows without key or time have no frame.
    ``open_start`` leaves out ``t - width`` itself; only rows for which ``counted`` holds are in a
    frame. A frame is the running total inside the row's own slot, the full slots before it, and the
    tail of the slot ``width`` back.
    """
    span = micros(width)
    step = span // slots
    if step * slots != span:
        raise ValueError("slots must divide the width into whole microseconds")

    ticks = _ticks(df, key, ts, value, counted).withColumn("slot", _slot(F.col("us"), step))
    sum_of, mean_of = _typed(df, value)
    measures = ["n", "nv", "s", "lo", "hi"]
    totals = ticks.groupBy("k", "slot").agg(
        *[F.sum(c).alias(c) for c in ("n", "nv", "s")], F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    full = Window.partitionBy("k").orderBy("slot").rangeBetween(step - span, -step)
    middle = totals.select(
        "k", "slot", (F.col("slot") - 1).alias("pos"), F.lit("middle").alias("kind"),
        *[F.sum(c).over(full).alias(c) for c in ("n", "nv", "s")],
        F.min("lo").over(full).alias("lo"), F.max("hi").over(full).alias("hi"),
    )
    own = _point("own", F.col("slot"), F.col("us"), measures)
    tail = _point("tail", F.col("slot") + span, F.col("us") + (span - int(open_start)), measures)
    points = ticks.select("k", F.inline(F.array(own, tail))).unionByName(middle)

    peers = Window.unboundedPreceding, Window.currentRow
    forward = Window.partitionBy("k", "slot").orderBy(F.col("pos").asc()).rangeBetween(*peers)
    backward = Window.partitionBy("k", "slot").orderBy(F.col("pos").desc()).rangeBetween(*peers)
    is_tail = F.col("kind") == "tail"

    def over(agg, name: str) -> tuple[Column, Column]:
        return (
            agg(F.when(~is_tail, F.col(name))).over(forward),
            agg(F.when(is_tail, F.col(name))).over(backward),
        )

    def total(name: str) -> Column:
        a, b = over(F.sum, name)
        zero = F.lit(0)
        return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(F.coalesce(a, zero) + F.coalesce(b, zero))

    stats = (
        points.select(
            "k", "pos", "kind",
            total("n").alias("n"), total("nv").alias("nv"), total("s").alias("s"),
            F.least(*over(F.min, "lo")).alias("lo"), F.greatest(*over(F.max, "hi")).alias("hi"),
        )
        .where(F.col("kind") == "own")
        .select(
            "k",
            F.col("pos").alias("us"),
            F.col("n").alias(f"{prefix}count"),
            sum_of.alias(f"{prefix}sum"),
            mean_of.alias(f"{prefix}avg"),
            F.col("lo").alias(f"{prefix}min"),
            F.col("hi").alias(f"{prefix}max"),
        )
    )
    return _attach(df, stats, key, ts)


def totals_after(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    lookback: timedelta,
    *,
    slot: timedelta | None = None,
    counted: Column | None = None,
    prefix: str = "",
) -> DataFrame:
    """Count and sum of all rows of the key later than ``t - lookback`` (no upper bound), per row.

    Only rows for which ``counted`` holds count; rows without key or time get NULL.
    """
    back = micros(lookback)
    step = micros(slot) if slot else max(back // 60, 1)
    ticks = _ticks(df, key, ts, value, counted)
    sum_of, _ = _typed(df, value)
    start = F.col("us") - back
    nothing = F.lit(None).cast("long")
    value_point = F.struct(
        _slot(F.col("us"), step).alias("slot"), (F.col("us") * 2).alias("pos"), nothing.alias("us"), F.col("n"), F.col("s")
    )
    # A probe sorts between the values at its own time and the later ones.
    probe = F.struct(
        _slot(start, step).alias("slot"), (start * 2 + 1).alias("pos"), F.col("us"),
        F.lit(0).cast("long").alias("n"), F.lit(None).cast(ticks.schema["s"].dataType).alias("s"),
    )
    points = ticks.select("k", F.inline(F.array(value_point, probe)))
    later = points.groupBy("k", "slot").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    newest_first = _before(["k"], F.col("slot").desc())
    carry = later.select(
        "k", "slot", F.lit((1 << 63) - 1).alias("pos"), nothing.alias("us"),
        F.sum("n").over(newest_first).alias("n"), F.sum("s").over(newest_first).alias("s"),
    )
    down = _running(["k", "slot"], F.col("pos").desc())
    stats = (
        points.unionByName(carry)
        .select("k", "us", F.sum("n").over(down).alias("n"), F.sum("s").over(down).alias("s"))
        .where(F.col("us").isNotNull())
        .select("k", "us", F.col("n").alias(f"{prefix}count"), sum_of.alias(f"{prefix}sum"))
    )
    return _attach(df, stats, key, ts)


def running_totals(
    df: DataFrame, keys: Sequence[str], sequence: str, value: str, *, slot: int = 100_000, start: DataFrame | None = None
) -> DataFrame:
    """Running count, total, max and min per key in ``sequence`` order.

    ``sequence`` is a whole number unique per key (an id or log offset), so a slot holds at most
    ``slot`` rows. ``start`` has one row per key with the totals reached earlier.
    """
    state = ["n", "total", "hi", "lo"]
    merge = {"n": F.sum, "total": F.sum, "hi": F.max, "lo": F.min}
    rows = df.select(
        *keys,
        _slot(F.col(sequence), slot).alias("slot"),
        F.col(sequence).alias("seq"),
        F.lit(1).cast("long").alias("n"),
        *[F.col(value).alias(c) for c in ("total", "hi", "lo")],
    )
    sums = rows.groupBy(*keys, "slot").agg(*[merge[c](c).alias(c) for c in state])
    known = sums
    if start is not None:
        # Before every slot of the key.
        known = sums.unionByName(start.select(*keys, F.lit(-(1 << 63)).alias("slot"), *state))
    earlier = _before(keys, F.col("slot"))
    carry = known.select(
        *keys, "slot", F.lit(None).cast("long").alias("seq"), *[merge[c](c).over(earlier).alias(c) for c in state]
    ).where(F.col("n").isNotNull())
    along = _running([*keys, "slot"], F.col("seq").asc_nulls_first())
    return (
        rows.unionByName(carry)
        .select(*keys, "slot", "seq", *[merge[c](c).over(along).alias(c) for c in state])
        .where(F.col("seq").isNotNull())
        .drop("slot")
    )


def running_steps(df: DataFrame, key: str, ts: str, step: str, name: str, *, slot: timedelta = HOUR) -> DataFrame:
    """Running sum of ``step`` per key at every time a step happens: (key, us, name)."""
    ticks = df.groupBy(F.col(key).alias("k"), F.unix_micros(F.col(ts)).alias("us")).agg(F.sum(step).alias("s"))
    ticks = ticks.withColumn("slot", _slot(F.col("us"), micros(slot)))
    sums = ticks.groupBy("k", "slot").agg(F.sum("s").alias("s"))
    carry = sums.select(
        "k", F.lit(None).cast("long").alias("us"), F.sum("s").over(_before(["k"], F.col("slot"))).alias("s"), "slot"
    ).where(F.col("s").isNotNull())
    along = _running(["k", "slot"], F.col("us").asc_nulls_first())
    running = ticks.unionByName(carry).select("k", "us", F.sum("s").over(along).alias(name))
    return running.where(F.col("us").isNotNull()).withColumnRenamed("k", key)


def previous_row(
    df: DataFrame, key: str, ts: str, tie: str, columns: Sequence[str], *, slots: Sequence[timedelta] = (DAY, SECOND),
    prefix: str = "prev_",
) -> DataFrame:
    """Values of ``columns`` in the key's previous row, ordered by (ts, tie).

    Time is cut into ``slots``, each a part of the one before. The last row of every finest slot is
    found with map-side combine and handed on within the slot around it, then between those, so that
    no task sees more than one fine slot of a key or the summaries of one coarse slot. Rows without
    key or time have no previous row and are none.
    """
    known = F.col(key).isNotNull() & F.col(ts).isNotNull()
    names = [f"_slot{i}" for i in range(len(slots))]
    rows = df.withColumns({
        # Rows that take no part are spread instead of sharing one group.
        **{n: F.when(known, _slot(F.unix_micros(F.col(ts)), micros(w))).otherwise(F.xxhash64(tie)) for n, w in zip(names, slots, strict=True)},
        "_seen": F.struct(*[F.col(c) for c in columns]),
        "_known": known,
        "_row": F.lit(True),
    })
    last = [rows.where("_known").groupBy(key, *names).agg(F.max_by("_seen", F.struct(ts, tie)).alias("_seen"))]
    for depth in range(len(names) - 1, 0, -1):
        last.insert(0, last[0].groupBy(key, *names[:depth]).agg(F.max_by("_seen", names[depth]).alias("_seen")))
    entering = None
    for depth, own in enumerate(last):
        around, name = [key, *names[:depth]], names[depth]
        if entering is not None:
            # What enters the slot around comes before its first part.
            own = own.unionByName(entering.withColumn(name, F.lit(-(1 << 63))))
        earlier = F.lag("_seen").over(Window.partitionBy(*around).orderBy(name))
        entering = own.select(*around, name, earlier.alias("_seen")).where(F.col("_seen").isNotNull())
    order = Window.partitionBy(key, *names).orderBy(F.col("_row").asc_nulls_first(), F.col(ts).asc(), F.col(tie).asc())
    out = rows.unionByName(entering, allowMissingColumns=True).withColumn("_prev", F.lag("_seen").over(order))
    return out.where(F.col("_row")).select(
        *df.columns, *[F.when(F.col("_known"), F.col(f"_prev.{c}")).alias(f"{prefix}{c}") for c in columns]
    )


def asof_latest(
    probes: DataFrame,
    values: DataFrame,
    key: str,
    probe_ts: str,
    value_ts: str,
    ttl: timedelta | None = None,
    *,
    slot: timedelta = HOUR,
) -> DataFrame:
    """Newest row of ``values`` per probe that is not later than it and not older than ``ttl``.

    Every probe is kept; its value columns are NULL when nothing qualifies, as for every probe
    without key or time. Probes of equal time share one lookup.
    """
    step = micros(slot)
    fields = [c for c in values.columns if c != key]
    image = F.struct(*[F.col(c) for c in fields])
    seen = (
        values.where(F.col(key).isNotNull() & F.col(value_ts).isNotNull())
        .groupBy(F.col(key).alias("k"), F.unix_micros(F.col(value_ts)).alias("us"))
        .agg(F.max_by(image, F.xxhash64(image)).alias("seen"))
        .withColumn("kind", F.lit(0))
    )
    known = probes.where(F.col(key).isNotNull() & F.col(probe_ts).isNotNull())
    asked = known.groupBy(F.col(key).alias("k"), F.unix_micros(F.col(probe_ts)).alias("us")).agg(F.lit(1).alias("kind"))
    points = seen.unionByName(asked, allowMissingColumns=True).withColumn("slot", _slot(F.col("us"), step))
    newest = F.max_by("seen", F.when(F.col("kind") == 0, F.col("us")))
    slots = points.groupBy("k", "slot").agg(newest.alias("seen"))
    carry = slots.select(
        "k", "slot", F.col("slot").alias("us"), F.lit(-1).alias("kind"),
        F.last("seen", ignorenulls=True).over(_before(["k"], F.col("slot"))).alias("seen"),
    ).where(F.col("seen").isNotNull())
    along = _running(["k", "slot"], F.col("us"), F.col("kind"))
    found = (
        points.unionByName(carry)
        .withColumn("seen", F.last("seen", ignorenulls=True).over(along))
        .where(F.col("kind") == 1)
        .select(F.col("k").alias(key), "us", "seen")
    )
    if ttl is not None:
        fresh = F.unix_micros(F.col(f"seen.{value_ts}")) >= F.col("us") - micros(ttl)
        found = found.withColumn("seen", F.when(fresh, F.col("seen")))
    taken = set(probes.columns)
    rows = probes.withColumn("us", F.unix_micros(F.col(probe_ts))).join(found, [key, "us"], "left")
    return rows.select(
        *probes.columns, *[F.col(f"seen.{c}").alias(c if c not in taken else f"feature_{c}") for c in fields]
    )
