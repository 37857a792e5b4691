"""Equi, interval, semi and anti joins.

No side is broadcast by hint: adaptive execution broadcasts what it has measured to be small, and splits
hot partitions of the sort-merge join otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.columns import epoch_micros
from pulsegrid.sources.scratch import cut

_BIN = "__bin"

#: Pairs of rows a task of an interval join compares in one tile at most, in expectation.
TILE_PAIRS = 1 << 24


def micros(width: timedelta) -> int:
    return width // timedelta(microseconds=1)


def bin_of(at: Column, width: timedelta) -> Column:
    """Number of the ``width``-long bin that holds ``at`` (microseconds); whole-number arithmetic only."""
    size = F.lit(micros(width))
    return F.floor((at - F.pmod(at, size)) / size)


def time_bin(time: str, width: timedelta) -> Column:
    return bin_of(epoch_micros(time), width)


def heavy_bins(left: DataFrame, right: DataFrame, keys: Sequence[str], pairs: int) -> DataFrame:
    """``keys`` that hold more than ``pairs`` pairs of rows, and into how many slices (``rows_in``, ``columns_in``) to
    cut the rows of ``left`` and ``right``, so that no pair of slices has more. Both sides are counted in each task first."""
    n, m, cells = F.col("__n").cast("double"), F.col("__m").cast("double"), F.lit(float(pairs))
    counts = [df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)) for df, name in ((left, "__n"), (right, "__m"))]
    side = F.sqrt(cells)
    # As square as the sides allow: a short side stays whole.
    return (
        counts[0]
        .join(counts[1], list(keys))
        .where(n * m > cells)
        .select(
            *keys,
            F.ceil(n / F.greatest(side, cells / m)).cast("int").alias("rows_in"),
            F.ceil(m / F.greatest(side, cells / n)).cast("int").alias("columns_in"),
        )
    )


def _deal(df: DataFrame, heavy: DataFrame, keys: Sequence[str], own: str, other: str) -> DataFrame:
    """Rows of heavy keys with a slice of their own side (``own``) and once per slice of the ``other`` side. The slice is
    a hash of the row, so retried tasks agree."""
    values = [F.col(c) for c, kind in df.dtypes if not kind.startswith("map")]
    placed = df.withColumn("__hash", F.xxhash64(*values)).join(heavy, list(keys), "left")
    one = F.lit(1)
    return placed.withColumns(
        {
            own: F.pmod(F.col("__hash"), F.coalesce(F.col(own), one).cast("long")).cast("int"),
            other: F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), one) - 1)),
        }
    ).drop("__hash")


def interval_join(
    points: DataFrame,
    windows: DataFrame,
    on: Sequence[str],
    point_time: str,
    window_time: str,
    before: timedelta,
    after: timedelta,
    bin_width: timedelta | None = None,
    tile_pairs: int | None = TILE_PAIRS,
) -> DataFrame:
    """Pairs with equal ``on`` and ``window_time - before <= point_time <= window_time + after``.

    Time bins join the key: a point lies in one bin, a window in the bins it touches (at most two at the
    default width, the window length). Pairs are therefore tested within a key's bin and not within its
    whole history, and a hot key spreads over its bins. Give the larger table as ``points``: only
    ``windows`` is repeated. Other column names must differ between the two sides.

    A key and bin with more than ``tile_pairs`` pairs to compare is cut into tiles of point rows by window rows, each
    joined on its own: a row is repeated once per slice of the other side, which is about one row per 4096 pairs. Which
    bins are heavy is counted when this is called, from key and time alone, and written below the shared folder; without
    any, the plan is the plain join. Equal rows share a slice of their side; the other side is cut all the same.
    ``tile_pairs=None`` counts nothing and cuts nothing.
    """
    shared = (set(points.columns) & set(windows.columns)) - set(on)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    width = bin_width or before + after
    first = bin_of(epoch_micros(window_time) - micros(before), width)
    last = bin_of(epoch_micros(window_time) + micros(after), width)
    left = points.where(F.col(point_time).isNotNull()).withColumn(_BIN, time_bin(point_time, width))
    right = (
        windows.where(F.col(window_time).isNotNull())
        .withColumn(_BIN, F.explode(F.sequence(first, last)))
        .withColumns({"__lo": F.col(window_time) - F.lit(before), "__hi": F.col(window_time) + F.lit(after)})
    )
    keys = [*on, _BIN]
    if tile_pairs is not None:
        heavy = cut(heavy_bins(left, right, keys, tile_pairs), "heavy-bins")
        if not heavy.isEmpty():
            left = _deal(left, heavy, keys, "rows_in", "columns_in").withColumnsRenamed({"rows_in": "__row", "columns_in": "__column"})
            right = _deal(right, heavy, keys, "columns_in", "rows_in").withColumnsRenamed({"rows_in": "__row", "columns_in": "__column"})
            keys += ["__row", "__column"]
    right = right.withColumnsRenamed({c: f"__r_{c}" for c in keys})
    match = [F.col(c) == F.col(f"__r_{c}") for c in keys]
    inside = F.col(point_time).between(F.col("__lo"), F.col("__hi"))
    joined = left.join(right, reduce(lambda a, b: a & b, [*match, inside]), "inner")
    return joined.select(*points.columns, *[c for c in windows.columns if c not in on])


def lookup(facts: DataFrame, dimension: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Left join to a table with unique keys; facts without a match keep NULLs."""
    return facts.join(dimension, on, "left")


def outer_join_all(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer join of tables that each hold ``key`` once, in one shuffle however many they are.

    The tables are stacked, each with its own columns, and a key's rows are folded into one. A table that holds a key
    twice is an error when the result is read. NULL keys match nothing: each table's row of that key stays by itself.
    Other column names must differ between the tables.
    """
    tables = list(tables)
    columns = [(i, field) for i, t in enumerate(tables) for field in t.schema.fields if field.name != key]
    names = [field.name for _, field in columns]
    if len(set(names)) < len(names):
        raise ValueError(f"columns in several tables: {sorted({c for c in names if names.count(c) > 1})}")

    def stacked(i: int) -> DataFrame:
        own = [F.col(f.name) if j == i else F.lit(None).cast(f.dataType).alias(f.name) for j, f in columns]
        alone = F.when(F.col(key).isNull(), F.lit(i)).alias("__alone")
        return tables[i].select(key, alone, *[F.lit(int(j == i)).cast("long").alias(f"__in{j}") for j in range(len(tables))], *own)

    rows = reduce(DataFrame.unionByName, [stacked(i) for i in range(len(tables))])
    often = F.greatest(F.lit(0).cast("long"), *[F.sum(f"__in{i}") for i in range(len(tables))])
    folded = rows.groupBy(key, "__alone").agg(*[F.first(c, ignorenulls=True).alias(c) for c in names], often.alias("__often"))
    checked = folded.where(F.when(F.col("__often") > 1, F.raise_error(F.lit(f"a table holds a {key} twice")).cast("boolean")).otherwise(True))
    return checked.select(key, *names)


def keep_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    names = [on] if isinstance(on, str) else list(on)
    return df.join(keys.select(*names), names, "left_semi")


def pending(records: DataFrame, scored: DataFrame, models: Mapping[str, str], key: str = "study_id") -> DataFrame:
    """(key, model, version) still to be scored: every record under every current model version, minus done.

    ``models`` maps name to version. A new version makes all records of that model pending again.
    """
    wanted = F.array(
        *[F.struct(F.lit(m).alias("model"), F.lit(v).alias("version")) for m, v in sorted(models.items())]
    )
    todo = records.select(key, F.explode(wanted).alias("want")).select(key, "want.model", "want.version")
    return todo.join(scored.select(key, "model", "version"), [key, "model", "version"], "left_anti")


def attach_labels(
    records: DataFrame, labs: DataFrame, stays: DataFrame, key: str = "study_id"
) -> DataFrame:
    """Records with laboratory and stay labels; both label tables hold ``key`` once."""
    return lookup(lookup(records, labs, key), stays, key)
