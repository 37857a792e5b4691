"""Expressions over a lead-major signal, ``array<array<double>>`` (leads x samples).

Whatever a per-sample lambda uses from outside, a per-row mean as well as the signal itself, is bound as a
lambda argument (``_let``). As a plain column it would be inlined into the lambda, with the expression that
computes it, and evaluated again for each sample.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.columns import as_column
from pulsegrid.functions.hashing import unit_hash


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _count(values: Column) -> Column:
    """Length, or NULL for an empty array so that the statistics of nothing are NULL."""
    return F.nullif(F.size(values), F.lit(0))


def mean_of(values: Column) -> Column:
    return _total(values) / _count(values)


def _centred(values: Column, mean: Column) -> Column:
    return F.transform(values, lambda x: x - mean)


def _root_mean_square(values: Column) -> Column:
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x * x) / _count(values))


def std_of(values: Column, mean: Column) -> Column:
    """Population standard deviation around a bound mean.

    Centring first and squaring the bound result is measurably faster than squaring a difference inside the
    running sum, since each step then evaluates fewer nodes.
    """
    return _let(_centred(values, mean), _root_mean_square)


def has_nan(values: Column) -> Column:
    """NaN or NULL among the samples. NaN sorts above every number, so one native pass for the maximum finds it."""
    return F.coalesce(F.isnan(F.array_max(values)), F.lit(False)) | F.exists(values, lambda x: x.isNull())


def is_flat(lead: Column) -> Column:
    """Constant lead; a lead with NaN or NULL is never flat (they equal nothing, themselves included)."""
    top = F.array_max(lead)
    whole = ~F.exists(lead, lambda x: x.isNull())
    return F.coalesce(~F.isnan(top) & (F.array_min(lead) == top), F.lit(False)) & whole


def lead_stats(signal: Column | str) -> Column:
    """Array of (min, max, mean, sd, has_nan, flat), one struct per lead."""

    def stats(lead: Column) -> Column:
        return _let(
            mean_of(lead),
            lambda m: F.struct(
                F.when(has_nan(lead), float("nan")).otherwise(F.array_min(lead)).alias("min"),
                F.when(has_nan(lead), float("nan")).otherwise(F.array_max(lead)).alias("max"),
                m.alias("mean"),
                std_of(lead, m).alias("sd"),
                has_nan(lead).alias("has_nan"),
                is_flat(lead).alias("flat"),
            ),
        )

    return F.transform(as_column(signal), stats)


def signal_summary(signal: Column | str) -> Column:
    """Mean and population sd over all samples of all leads, as one struct; NaN if a sample is NULL."""
    flat = F.transform(F.flatten(as_column(signal)), lambda x: F.coalesce(x, F.lit(float("nan"))))
    return _let(
        flat,
        lambda v: _let(mean_of(v), lambda m: F.struct(m.alias("mean"), std_of(v, m).alias("sd"))),
    )


def any_nan(signal: Column | str) -> Column:
    return F.exists(as_column(signal), has_nan)


def any_flat(signal: Column | str) -> Column:
    """Some lead is constant (called "all zeros" in quality reports)."""
    return F.exists(as_column(signal), is_flat)


def is_sound(signal: Column | str) -> Column:
    """Leads there are, each with samples, without NaN or NULL, and not constant."""

    def varies(lead: Column) -> Column:
        whole = ~F.exists(lead, lambda x: x.isNull())
        return _let(F.array_max(lead), lambda top: F.coalesce(~F.isnan(top) & (F.array_min(lead) < top) & whole, F.lit(False)))

    leads = as_column(signal)
    return F.coalesce((F.size(leads) > 0) & F.forall(leads, varies), F.lit(False))


def zscore(signal: Column | str) -> Column:
    """Per lead (x - mean) / population sd; NULL samples for a flat lead, which has no scale."""

    def by_its_sd(centred: Column) -> Column:
        return _let(
            F.nullif(_root_mean_square(centred), F.lit(0.0)), lambda s: F.transform(centred, lambda x: x / s)
        )

    def scale(lead: Column) -> Column:
        return _let(mean_of(lead), lambda m: _let(_centred(lead, m), by_its_sd))

    return F.transform(as_column(signal), scale)


def flatten_signal(signal: Column | str) -> Column:
    """Lead-major flat array: all samples of lead 0, then lead 1, ..."""
    return F.flatten(as_column(signal))


def reshape(flat: Column | str, rows: int) -> Column:
    """Inverse of ``flatten_signal`` for ``rows`` leads."""

    def cut(values: Column) -> Column:
        width = (F.size(values) / rows).cast("int")
        return F.transform(
            F.sequence(F.lit(0), F.lit(rows - 1)), lambda r: F.slice(values, (r * width + 1).cast("int"), width)
        )

    return _let(as_column(flat), cut)


def to_time_major(signal: Column | str) -> Column:
    """True transpose, samples x leads."""

    def turn(leads: Column) -> Column:
        samples = F.size(F.get(leads, F.lit(0)))
        rows = F.transform(
            F.sequence(F.lit(0), samples - 1), lambda i: F.transform(leads, lambda lead: F.get(lead, i))
        )
        return F.when(samples > 0, rows).otherwise(F.array().cast("array<array<double>>"))

    return _let(as_column(signal), turn)


def augment_noise(
    signal: Column | str, key: Column | str, seed: int = 42, epoch: int = 0, mode: str = "xxhash64"
) -> Column:
    """Add uniform noise in [-0.5, 0.5), a function of (seed, epoch, key, lead, sample) only."""
    key = as_column(key)

    def noisy(lead: Column, lead_no: Column) -> Column:
        return F.transform(
            lead, lambda x, i: x + unit_hash(F.lit(epoch), key, lead_no, i, seed=seed, mode=mode) - 0.5
        )

    return F.transform(as_column(signal), noisy)


def explode_signal(
    df: DataFrame, keys: Sequence[str], signal: str = "signal", lead_names: Sequence[str] | None = None
) -> DataFrame:
    """Long form: keys, lead number (and name), sample number ``i``, ``value``."""
    leads = df.select(*keys, F.posexplode(signal).alias("lead", "samples"))
    if lead_names is not None:
        names = F.array(*[F.lit(n) for n in lead_names])
        leads = leads.withColumn("lead_name", F.get(names, F.col("lead")))
    kept = [c for c in leads.columns if c != "samples"]
    return leads.select(*kept, F.posexplode("samples").alias("i", "value"))
