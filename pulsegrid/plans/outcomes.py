"""Predicted age against outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.functions.columns import age_delta, cap_filter, icu_mort, offset
from pulsegrid.operators.aggregates import rates_by
from pulsegrid.operators.joins import keep_keys, lookup
from pulsegrid.operators.quantiles import quantile_bin
from pulsegrid.operators.sampling import sample_groups
from pulsegrid.plans.cohort import first_recordings, stay_recordings
from pulsegrid.sources.scratch import cut


def first_with_delta(records: DataFrame, stays: DataFrame, scores: DataFrame, below: float = 90.0) -> DataFrame:
    """First recording per stay of patients younger than ``below``, with prediction error and death in ICU."""
    firsts = lookup(first_recordings(records, stays), scores, "study_id")
    return cap_filter(firsts, "admission_age", below, inclusive=False).withColumns(
        {"age_delta": age_delta(), "icu_mort": icu_mort()}
    )


def mortality_by_bin(
    scored: DataFrame, q: int = 10, exact: bool = True, decimals: int | None = None
) -> DataFrame:
    """Death rates per quantile bin of ``age_delta``; rows without a prediction have no bin and drop out.

    Exact quantiles read their input three times, so the three narrow columns are written once instead of
    repeating the joins behind them.
    """
    narrow = scored.select("age_delta", "hospital_expire_flag", "icu_mort")
    narrow = cut(narrow, "age-delta") if exact else narrow
    binned = quantile_bin(narrow, "age_delta", q, exact, decimals).where(F.col("bin").isNotNull())
    return rates_by(binned, ["bin", "bin_lo", "bin_hi"], ["hospital_expire_flag", "icu_mort"])


def age_mortality(
    records: DataFrame, stays: DataFrame, scores: DataFrame, q: int = 10, exact: bool = True, decimals: int | None = None
) -> DataFrame:
    return mortality_by_bin(first_with_delta(records, stays, scores), q, exact, decimals)


def age_over_time(
    records: DataFrame, stays: DataFrame, scores: DataFrame, n_stays: int = 250, seed: int = 42, mode: str = "xxhash64"
) -> DataFrame:
    """Prediction error against hours since ICU admission for a sample of stays with several recordings.

    "Highest sequence number above 1" is "more than one row", so the stays are found by a plain count and the
    rows need no numbering.
    """
    rows = stay_recordings(records, stays)
    several = rows.groupBy("stay_id").count().where(F.col("count") > 1)
    followed = lookup(keep_keys(rows, several, "stay_id"), scores, "study_id").withColumns(
        {"age_delta": age_delta(), "ecg_delta": offset("ecg_time", "icu_intime", "hour")}
    )
    return sample_groups(followed, "stay_id", n_stays, seed, mode)
