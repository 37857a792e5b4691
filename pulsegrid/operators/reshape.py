"""Long to wide, wide to long, and unions with a source tag."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.schemas import LAB_LABELS


def labels_wide(
    pairs: DataFrame,
    labels: Sequence[str] = LAB_LABELS,
    key: str = "study_id",
    label: str = "label",
    value: str = "valuenum",
    offset: str = "offset",
    ties: Sequence[str] = ("charttime", "labevent_id"),
    coherent: bool = True,
) -> DataFrame:
    """``<label>`` and ``<label>_offset`` of the nearest pair, one row per key with any labelled pair.

    One aggregation with a condition per label; pairs without a label are left out (``count_unlabelled``).
    """
    order = F.struct(F.abs(offset).alias("distance"), *ties)
    columns = []
    for name in labels:
        of_label = F.lower(label) == name
        valued = F.when(of_label & F.col(value).isNotNull(), order)
        columns.append(F.min_by(value, valued).alias(name))
        columns.append(F.min_by(offset, valued if coherent else F.when(of_label, order)).alias(f"{name}_offset"))
    return pairs.where(F.col(label).isNotNull()).groupBy(key).agg(*columns)


def count_unlabelled(pairs: DataFrame, label: str = "label") -> DataFrame:
    return pairs.agg(F.count(F.when(F.col(label).isNull(), 1)).alias("n_unlabelled"))


def pivot_metric(df: DataFrame, index: str, columns: str, values: str, names: Sequence[str]) -> DataFrame:
    """One column per entry of ``names`` (the values of ``columns``), one row per ``index``."""
    return df.groupBy(index).pivot(columns, list(names)).agg(F.first(values, ignorenulls=True))


def unpivot_metrics(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per id and metric: ``name``, ``value``."""
    return df.unpivot(list(ids), list(values), "name", "value")


def union_tagged(tables: Mapping[str, DataFrame], tag: str = "source") -> DataFrame:
    """Union by column name with a tag per table; columns a table lacks are NULL."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
