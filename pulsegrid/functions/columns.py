"""Scalar column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Last 'loss of precision free' step from an interval to a number: 12 integer digits of seconds,
# 6 of microseconds, which still fits a 64-bit decimal.
_SECONDS = "decimal(18,6)"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    """Exact wall-clock difference in seconds (microsecond decimal), independent of the session zone."""
    gap = as_column(later) - as_column(earlier)
    return gap.cast("interval second").cast(_SECONDS)


def epoch_micros(time: Column | str) -> Column:
    """Microseconds since 1970-01-01 on the wall clock, as a long."""
    return (seconds_between(time, F.expr("timestamp_ntz'1970-01-01'")) * 1000000).cast("long")


def offset(later: Column | str, earlier: Column | str, unit: str = "minute") -> Column:
    """Signed offset as a double, fractions kept."""
    per_unit = {"second": 1.0, "minute": 60.0, "hour": 3600.0}[unit]
    return seconds_between(later, earlier).cast("double") / F.lit(per_unit)


def select_rename(df: DataFrame, mapping: Mapping[str, str], lower: bool = False) -> DataFrame:
    """Keep the mapped columns under their new names, lower-cased on request."""
    return df.select(*[F.col(old).alias(new.lower() if lower else new) for old, new in mapping.items()])


def parse_times(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Turn text into wall-clock timestamps; by default every column with "time" after its first character."""
    names = [c for c in df.columns if c.find("time") > 0] if cols is None else list(cols)
    return df.withColumns({c: F.col(c).cast(T.TimestampNTZType()) for c in names})


def anchored_age(time: str = "ecg_time", year: str = "anchor_year", age: str = "anchor_age") -> Column:
    """Age at ``time`` for a patient who is ``age`` in the (shifted) calendar year ``year``."""
    return F.year(time) - F.col(year) + F.col(age)


def icu_expire_flag(out: str = "icu_outtime", discharge: str = "dischtime") -> Column:
    """1 when the ICU stay ends no earlier than the discharge, 0 otherwise or when either is missing."""
    return F.coalesce((F.col(out) >= F.col(discharge)).cast("int"), F.lit(0))


def icu_mort(
    out: str = "icu_outtime", discharge: str = "dischtime", died: str = "hospital_expire_flag"
) -> Column:
    """As ``icu_expire_flag`` but the patient must also have died in hospital; never NULL."""
    return F.coalesce((F.col(out) >= F.col(discharge)) & (F.col(died) == 1), F.lit(False))


def encode_binary(col: Column | str, positive: str = "M") -> Column:
    """1 for ``positive``, 0 for anything else including missing."""
    return F.when(as_column(col) == positive, 1).otherwise(0)


def age_delta(pred: str = "age_pred", actual: str = "admission_age") -> Column:
    return F.col(pred) - F.col(actual)


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN where the type has one."""
    col = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def drop_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    for name in cols:
        df = df.where(~is_missing(df, name))
    return df


def nan_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing is NULL inside the library; apply where NaN-coded data comes in."""
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in cols})


def fill_nan(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL -> NaN, for the boundary to tensor code only."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols})


def cap_filter(df: DataFrame, col: str, limit: float, inclusive: bool = True) -> DataFrame:
    """Upper bound; missing values do not pass."""
    bounded = F.col(col) <= limit if inclusive else F.col(col) < limit
    return df.where(bounded)


def parse_model_name(df: DataFrame, col: str = "model") -> DataFrame:
    """``dir/cnn-age-history.csv`` -> model ``cnn-age``, arch ``cnn``, task ``age`` (``age2`` counts as ``age``).

    A history written by Spark is a folder of that name; the files below it give the same model.
    """
    path = F.col(col)
    from_history = F.regexp_extract(path, r"([^/]+)-history\.csv", 1)
    model = F.when(from_history != "", from_history).otherwise(F.regexp_replace(path, ".*/", ""))
    parts = F.split(col, "[^0-9A-Za-z]+")
    task = F.get(parts, F.lit(1))
    return df.withColumn(col, model).withColumns(
        {"arch": F.get(parts, F.lit(0)), "task": F.when(task == "age2", "age").otherwise(task)}
    )
