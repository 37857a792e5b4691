"""Nearest event in a time window (as-of join in both directions), without forming pairs.

Joining every point to every event of its window and keeping the best pair costs (points x events) per key.
Here both sides are laid on one timeline per key and each point reads its neighbours from windows that
are cut into short time bins. Only whole numbers run through these steps, so all of them aggregate by hash:

1. points and events are reduced to distinct (key, time) rows with one bit per lookup, combined before the
   shuffle, so repeated stamps never pile up;
2. each short bin is summarised by its first and last event times; a window over the summaries of a stretch
   as long as the search window (a fixed number of bins) finds what earlier and later bins carry in;
3. windows over one short bin, plus the carried rows, give each point the time of its nearest event;
4. the events' values are fetched last, once per (key, time), from the event of the smallest ties there.

No task needs more than one short bin of one key, whatever share of all rows that key has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pulsegrid.functions.columns import epoch_micros
from pulsegrid.operators.joins import bin_of, micros

_AT, _BIN, _STRETCH, _EDGE, _POINT, _MASK = "__at", "__bin", "__stretch", "__edge", "__point", "__mask"
_WHICH, _EVENT_AT = "__which", "__event_at"


def nearest_in_window(
    points: DataFrame,
    events: DataFrame,
    on: Sequence[str],
    point_time: str,
    event_time: str,
    before: timedelta,
    after: timedelta,
    lookups: Mapping[str, Column],
    payload: Sequence[str],
    ties: Sequence[str] = (),
    bin_width: timedelta = timedelta(minutes=1),
) -> DataFrame:
    """``points`` plus, per lookup, a struct (ties, event time, payload) of the nearest event or NULL.

    ``lookups`` maps an output column to the condition its events meet (62 at most). An event is in reach when
    ``point_time - before <= event_time <= point_time + after``. Equal distances go to the earlier event,
    equal times to the smaller ``ties``. Events with equal times and ties are told apart by their payload, or,
    where the only tie is a whole number and the payload of fixed size, count as one, any of them.
    """
    on = list(on)
    names = list(lookups)
    taken = set(names) & set(points.columns)
    if taken:
        raise ValueError(f"lookups named like columns of the points: {sorted(taken)}")
    if len(names) > 62:
        raise ValueError("62 lookups at most")

    # Times are microseconds (long) from here on, and a lookup is a bit.
    bits = [F.when(cond, F.lit(1 << k)).otherwise(F.lit(0)) for k, cond in enumerate(lookups.values())]
    stamped = (
        events.where(F.col(event_time).isNotNull())
        .withColumns({_AT: epoch_micros(event_time), _MASK: reduce(lambda a, b: a.bitwiseOR(b), bits).cast("long")})
        .where(F.col(_MASK) != 0)
    )
    keyed = points.withColumn(_AT, epoch_micros(point_time))
    stamps = stamped.select(*on, _AT, F.lit(False).alias(_POINT), _MASK).unionByName(
        keyed.where(F.col(_AT).isNotNull()).select(
            *on, _AT, F.lit(True).alias(_POINT), F.lit(0).cast("long").alias(_MASK)
        )
    )
    timeline = stamps.groupBy(*on, bin_of(F.col(_AT), bin_width).alias(_BIN), _AT).agg(
        F.max(_POINT).alias(_POINT), F.bit_or(_MASK).alias(_MASK)
    )
    timeline = timeline.select(
        *on, _BIN, _AT, _POINT, *[F.when(F.getbit(_MASK, F.lit(k)) == 1, F.col(_AT)).alias(n) for k, n in enumerate(names)]
    )

    carried = _carried(timeline, on, names, before, after, bin_width)
    rows = timeline.withColumn(_EDGE, F.lit(0)).unionByName(carried, allowMissingColumns=True)
    order = W.partitionBy(*on, _BIN).orderBy(_EDGE, _AT)
    upto = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    # Times rise along the order, so the last one so far is the greatest.
    neighbours = rows.select(
        *on,
        _AT,
        _POINT,
        *[F.max(n).over(upto).alias(f"__prev_{n}") for n in names],
        *[_following(n, [*on, _BIN], [_EDGE, _AT]).alias(f"__next_{n}") for n in names],
    ).where(_POINT)

    def nearest(name: str) -> Column:
        prev, following = F.col(f"__prev_{name}"), F.col(f"__next_{name}")
        prev = F.when(F.col(_AT) - prev <= micros(before), prev)
        following = F.when(following - F.col(_AT) <= micros(after), following)
        closer = following - F.col(_AT) < F.col(_AT) - prev
        return F.when(closer, following).otherwise(F.coalesce(prev, following))

    found = F.array(*[F.struct(F.lit(k).alias(_WHICH), nearest(n).alias(_EVENT_AT)) for k, n in enumerate(names)])
    chosen = (
        neighbours.select(*on, _AT, F.explode(found).alias("__found"))
        .select(*on, _AT, "__found.*")
        .where(F.col(_EVENT_AT).isNotNull())
    )
    values = _fetched(chosen, stamped, on, names, event_time, payload, ties)
    return keyed.join(values, [*on, _AT], "left").select(*points.columns, *names)


def _fetched(
    chosen: DataFrame,
    events: DataFrame,
    on: Sequence[str],
    names: Sequence[str],
    event_time: str,
    payload: Sequence[str],
    ties: Sequence[str],
) -> DataFrame:
    """One row per (key, point time) with a struct per lookup, from rows that name a lookup and its event's time."""
    fields = [*ties, event_time, *payload]
    fixed = all(_fixed_size(events.schema[c].dataType) for c in fields)
    if len(ties) == 1 and fixed and isinstance(events.schema[ties[0]].dataType, T.IntegralType):
        # A missing tie comes first, as it does in a struct.
        rank = F.coalesce(F.col(ties[0]).cast("long"), F.lit(-(1 << 63)))
    else:
        rank = F.struct(*fields)

    def least(field: str, k: int) -> Column:
        met = F.getbit(_MASK, F.lit(k)) == 1
        return F.min_by(field, F.when(met, rank)).alias(f"__{k}_{field}")

    per_time = events.groupBy(*on, F.col(_AT).alias(_EVENT_AT)).agg(
        *[least(f, k) for k in range(len(names)) for f in fields]
    )
    joined = chosen.join(per_time, [*on, _EVENT_AT])
    # A point has one row per lookup: the greatest of one value is that value.
    own = [F.max(F.when(F.col(_WHICH) == k, F.col(f"__{k}_{f}"))).alias(f"__{k}_{f}") for k in range(len(names)) for f in fields]
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(_WHICH))
    gathered = joined.groupBy(*on, _AT).agg(F.bit_or(bit).alias(_MASK), *own)
    return gathered.select(
        *on,
        _AT,
        *[
            F.when(F.getbit(_MASK, F.lit(k)) == 1, F.struct(*[F.col(f"__{k}_{f}").alias(f) for f in fields])).alias(name)
            for k, name in enumerate(names)
        ],
    )


def _fixed_size(kind: T.DataType) -> bool:
    """Whether values can be updated in place, so that aggregation by hash holds them."""
    return isinstance(
        kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DayTimeIntervalType)
    )


def _following(name: str, partition: Sequence[str], order: Sequence[str]) -> Column:
    """The next non-null value after the current row, in the same sort order as the backward look.

    The SQL form is used for IGNORE NULLS, which walks forward once; a frame that ends at the last row would
    be read anew for each row.
    """
    part, by = (", ".join(f"`{c}`" for c in cols) for cols in (partition, order))
    return F.expr(f"lead(`{name}`) ignore nulls over (partition by {part} order by {by})")


def _carried(
    timeline: DataFrame,
    on: Sequence[str],
    names: Sequence[str],
    before: timedelta,
    after: timedelta,
    bin_width: timedelta,
) -> DataFrame:
    """Two rows per bin with points: the last event times of the bins before (edge -1), the first of those after (+1)."""
    ahead, back = -(-micros(before) // micros(bin_width)), -(-micros(after) // micros(bin_width))
    length = max(ahead + back, 1)
    summary = timeline.groupBy(*on, _BIN).agg(
        F.max(_POINT).alias(_POINT),
        *[F.min(n).alias(f"__first_{n}") for n in names],
        *[F.max(n).alias(f"__last_{n}") for n in names],
    )
    # A bin with events is of use to later bins within `before` and to earlier ones within `after`: two
    # stretches at most. A bin with points only asks, in its own stretch.
    home = F.floor(F.col(_BIN) / length)
    reached = F.sequence(F.floor((F.col(_BIN) - back) / length), F.floor((F.col(_BIN) + ahead) / length))
    useful = F.coalesce(*[F.col(f"__first_{n}") for n in names]).isNotNull()
    spread = summary.withColumn(_STRETCH, F.explode(F.when(useful, reached).otherwise(F.array(home))))
    place = [*on, _STRETCH]
    upto = W.partitionBy(*place).orderBy(_BIN).rowsBetween(W.unboundedPreceding, -1)
    sides = (
        spread.select(
            *on,
            _BIN,
            _STRETCH,
            _POINT,
            *[F.max(f"__last_{n}").over(upto).alias(f"__prev_{n}") for n in names],
            *[_following(f"__first_{n}", place, [_BIN]).alias(f"__next_{n}") for n in names],
        )
        .where(F.col(_POINT) & (F.col(_STRETCH) == home))
        .select(
            *on,
            _BIN,
            F.explode(
                F.array(
                    F.struct(F.lit(-1).alias(_EDGE), *[F.col(f"__prev_{n}").alias(n) for n in names]),
                    F.struct(F.lit(1).alias(_EDGE), *[F.col(f"__next_{n}").alias(n) for n in names]),
                )
            ).alias("side"),
        )
    )
    return sides.select(*on, _BIN, "side.*", F.lit(False).alias(_POINT))


def nearest_value(
    pairs: DataFrame,
    keys: Sequence[str],
    value: str = "valuenum",
    offset: str = "offset",
    ties: Sequence[str] = ("charttime", "labevent_id"),
    coherent: bool = True,
) -> DataFrame:
    """Per key the value and offset of the pair with the smallest absolute offset, over ready-made pairs.

    ``coherent=True`` takes both from the nearest pair that has a value. ``coherent=False`` takes the
    nearest value and, separately, the nearest offset, which may belong to a pair without a value.
    """
    order = F.struct(F.abs(offset).alias("distance"), *ties)
    valued = F.when(F.col(value).isNotNull(), order)
    offset_order = valued if coherent else F.when(F.col(offset).isNotNull(), order)
    return pairs.groupBy(*keys).agg(
        F.min_by(value, valued).alias(value),
        F.min_by(offset, offset_order).alias(offset),
    )
