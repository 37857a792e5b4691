"""One callable ``(spark, sf_dir) -> DataFrame`` per operator and job."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid import schemas
from pulsegrid.functions import columns as C
from pulsegrid.functions import signal as S
from pulsegrid.operators import aggregates as A
from pulsegrid.operators import bins, joins, metrics, quantiles, ranking, reshape, sampling, scoring, signals, splitting
from pulsegrid.operators.joins import interval_join, keep_keys, lookup, outer_join_all, pending
from pulsegrid.operators.nearest import nearest_value
from pulsegrid.plans import cohort, features, history, outcomes, quality
from pulsegrid.registry.proxies import HISTORY_MODELS, LEADS, SAMPLES, Proxies
from pulsegrid.sources import scores as score_store
from pulsegrid.sources import shards, tables
from pulsegrid.sources.scratch import cut, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def _query(build: Callable[[Proxies], DataFrame]) -> Callable[[Proxies], DataFrame]:
    """Register ``build`` under its own name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(Proxies(spark, sf_dir))

    _QUERIES[build.__name__] = run
    return build


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# Offsets are whole microseconds over 60e6 or 3.6e9, so six digits would often round an exact half.
EXACT_DIGITS = 10


def _round(df: DataFrame, digits: int = 6, **per_column: int) -> DataFrame:
    """Round double columns; adding zero turns -0.0 into 0.0."""
    doubles = [f.name for f in df.schema if f.dataType.typeName() == "double"]
    offsets = {c: EXACT_DIGITS for c in doubles if c.endswith("offset") or c == "ecg_delta"}
    places = {**offsets, **per_column}
    return df.withColumns({c: F.round(F.col(c), places.get(c, digits)) + F.lit(0.0) for c in doubles})


def _as_double(df: DataFrame, *cols: str) -> DataFrame:
    """Whole-number columns that can be NULL, as doubles: clients differ in how they show a NULL integer."""
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


# --- shared inputs -------------------------------------------------------------------------------


def _hosp(t: Proxies) -> DataFrame:
    """Stay recordings with their number in the stay."""
    return ranking.rank_in_group(cohort.stay_recordings(t.records, t.stays), ["stay_id"], "ecg_time", ["study_id"])


def _labs(t: Proxies) -> DataFrame:
    return cohort.lab_pairs(t.records, t.labevents, t.d_labitems)


def _delta(t: Proxies) -> DataFrame:
    return outcomes.first_with_delta(t.records, t.stays, t.scores)


def _split(t: Proxies) -> DataFrame:
    return cohort.split_recordings(t.records, t.patients, mode="md5")


def _features(t: Proxies) -> DataFrame:
    labs = cohort.lab_labels(t.records, t.labevents, t.d_labitems)
    stays = cohort.hosp_labels(t.records, t.stays)
    return features.build_features(_split(t), t.signals, labs, stays)


def _weighted() -> Column:
    """Position-weighted sum of a signal's samples."""
    places = F.transform(F.flatten("signal"), lambda x, i: x * (i + 1))
    return F.aggregate(places, F.lit(0.0), lambda acc, x: acc + x)


def _flat_features(rows: DataFrame) -> DataFrame:
    """Signal replaced by its size, one sample and a position-weighted sum."""
    summed = rows.withColumns(
        {
            "n_samples": F.size(F.flatten("signal")),
            "sample": F.get(F.get("signal", F.lit(1)), F.lit(2)),
            "weighted": _weighted(),
        }
    ).drop("signal")
    summed = _as_double(summed, "hospital_expire_flag", "icu_expire_flag")
    return _round(summed.toDF(*[c.replace(" ", "_") for c in summed.columns]))


def _linear(step: int):
    """A linear model whose weights are a function of the sample position."""

    def make_predict():
        def predict(batch: np.ndarray) -> np.ndarray:
            position = np.arange(batch.shape[1])
            return batch.astype(np.float64) @ (((position * step) % 11 - 5) / 10.0)

        return predict

    return make_predict


_MODELS = {
    name: scoring.Model(version, _linear(step), LEADS * SAMPLES)
    for name, version, step in (("cnn-age", "1", 3), ("resnet-age", "2", 7), ("resnet-sodium", "1", 5))
}


# --- sources and sinks ---------------------------------------------------------------------------


@_query
def read_csv_table(t: Proxies) -> DataFrame:
    path = scratch_path(t.spark, "patients-csv")
    # Columns stand in another order than in the schema, with one more among them.
    turned = t.patients.select(*reversed(t.patients.columns)).withColumn("note", F.lit("x"))
    tables.write_table(turned, path, "csv")
    return tables.read_table(t.spark, path, schemas.PATIENTS)


@_query
def read_typed_csv(t: Proxies) -> DataFrame:
    path = scratch_path(t.spark, "outcomes-csv")
    names = ["X", "Subject ID", "stayId", "Gender", "Admission Age", "ICU.intime", "Hospital Expire Flag"]
    out = t.stays.select(
        F.col("stay_id"), "subject_id", "stay_id", "gender", "admission_age", "icu_intime", "hospital_expire_flag"
    ).toDF(*names)
    tables.write_table(out.select(*[f"`{c}`" for c in reversed(names)]), path, "csv")
    kinds = ["long", "long", "long", "string", "double", "time", "int"]
    return tables.read_typed(t.spark, path, schemas.schema(**dict(zip(names, kinds))), skip=["x"])


def _write_histories(t: Proxies) -> str:
    """One history per model, written as a folder; those of gender models lack the mse columns."""
    root = scratch_path(t.spark, "histories")
    for name in HISTORY_MODELS:
        # A remark with commas, quotes and a line break stands before the numbers.
        remark = F.concat(F.lit('best, so far\nsaid "'), F.col("epoch").cast("string"), F.lit('", kept')).alias("remark")
        rows = t.history.where(F.col("model") == name).select("epoch", remark, *[c for c in t.history.columns if c not in ("model", "epoch")])
        if name.endswith("gender"):
            rows = rows.drop("mse", "val_mse")
        tables.write_table(rows, f"{root}/{name}-history.csv", "csv")
    return f"{root}/*-history.csv/*.csv"


@_query
def history_read_many(t: Proxies) -> DataFrame:
    rows = history.read_histories(t.spark, _write_histories(t))
    return rows.select("model", "arch", "task", "epoch", "loss", "val_loss", "mse", "val_mse")


@_query
def score_map_explode(t: Proxies) -> DataFrame:
    path = scratch_path(t.spark, "score-map")
    score_store.write_score_map(t.scores, path)
    return _round(score_store.read_score_map(t.spark, path))


@_query
def read_split_projection(t: Proxies) -> DataFrame:
    path = scratch_path(t.spark, "split-shards")
    shards.write_shards(_split(t), path)
    return _as_double(shards.read_split(t.spark, path, "train", ["study_id", "gender", "ecg_age"]), "ecg_age")


@_query
def shard_write_roundtrip(t: Proxies) -> DataFrame:
    path = scratch_path(t.spark, "shards")
    shards.write_shards(_split(t).select("study_id", "subject_id", "ecg_time", "split"), path)
    return t.spark.read.parquet(path)


# --- columns and predicates ----------------------------------------------------------------------


@_query
def parse_times(t: Proxies) -> DataFrame:
    text = t.stays.select(
        "stay_id", *[F.col(c).cast("string").alias(c) for c in ("admittime", "dischtime", "icu_intime", "icu_outtime")]
    )
    return C.parse_times(text)


@_query
def anchored_age(t: Proxies) -> DataFrame:
    return _as_double(cohort.with_demographics(t.records, t.patients).select("study_id", "ecg_age"), "ecg_age")


@_query
def lab_offsets(t: Proxies) -> DataFrame:
    pairs = _labs(t).withColumn("abs_offset", F.abs("offset"))
    return _round(pairs.select("study_id", "labevent_id", "offset", "abs_offset"))


@_query
def ecg_hours_from_icu(t: Proxies) -> DataFrame:
    rows = cohort.stay_recordings(t.records, t.stays)
    return _round(rows.select("stay_id", "study_id", C.offset("ecg_time", "icu_intime", "hour").alias("ecg_delta")))


@_query
def icu_expire_flag(t: Proxies) -> DataFrame:
    return t.stays.select("stay_id", C.icu_expire_flag().alias("icu_expire_flag"))


@_query
def icu_mort(t: Proxies) -> DataFrame:
    return t.stays.select("stay_id", C.icu_mort().alias("icu_mort"))


@_query
def gender_encode(t: Proxies) -> DataFrame:
    rows = cohort.with_demographics(t.records, t.patients)
    return rows.select(
        "study_id", C.encode_binary("gender").alias("gender"), F.col("gender").isNotNull().alias("gender_known")
    )


@_query
def age_delta(t: Proxies) -> DataFrame:
    return _round(_delta(t).select("stay_id", "study_id", "age_delta"))


@_query
def drop_missing_labels(t: Proxies) -> DataFrame:
    labs = C.fill_nan(cohort.lab_labels(t.records, t.labevents, t.d_labitems), ["potassium", "sodium"])
    return _round(C.drop_missing(labs, ["potassium"]).select("study_id", "potassium", "potassium_offset"))


@_query
def age_cap_filter(t: Proxies) -> DataFrame:
    upto = C.cap_filter(t.stays, "admission_age", 90.0, inclusive=True)
    below = C.cap_filter(upto, "admission_age", 90.0, inclusive=False).select("stay_id", F.lit(1).alias("strict"))
    return _as_double(lookup(upto.select("stay_id", "admission_age"), below, "stay_id"), "strict")


@_query
def cohort_filters(t: Proxies) -> DataFrame:
    rows = lookup(_hosp(t), t.scores, "study_id").withColumn("age_delta", C.age_delta())
    predicates = {
        "first": F.col("ecg_order") == 1,
        "later": F.col("ecg_order") > 1,
        "death": F.col("hospital_expire_flag") == 1,
        "much_younger": F.col("age_delta") < -10,
    }
    met = F.array_compact(F.array(*[F.when(cond, name) for name, cond in predicates.items()]))
    return rows.select("stay_id", "study_id", F.explode(met).alias("predicate"))


@_query
def model_name_parts(t: Proxies) -> DataFrame:
    paths = t.history.select(F.concat(F.lit("../data/"), "model", F.lit("-history.csv")).alias("model"), "epoch")
    return C.parse_model_name(paths)


# --- joins ---------------------------------------------------------------------------------------


@_query
def ecg_with_demographics(t: Proxies) -> DataFrame:
    rows = cohort.with_demographics(t.records, t.patients)
    return _as_double(rows.select("study_id", "subject_id", "gender", "ecg_age"), "ecg_age")


def _lab_interval_join(t: Proxies, **how: int) -> DataFrame:
    wanted = t.labevents.where(F.col("itemid").isin(*schemas.LAB_ITEM_IDS))
    windows = t.records.select("subject_id", "study_id", "ecg_time")
    window = cohort.LAB_WINDOW
    pairs = interval_join(wanted, windows, ["subject_id"], "charttime", "ecg_time", window, window, **how)
    return pairs.select("subject_id", "study_id", "labevent_id", "itemid", "valuenum", "charttime", "ecg_time")


@_query
def lab_interval_join(t: Proxies) -> DataFrame:
    return _lab_interval_join(t)


@_query
def lab_interval_join_tiles(t: Proxies) -> DataFrame:
    """The same pairs with small tiles, so that bins of the given tables are cut."""
    return _lab_interval_join(t, tile_pairs=2)


@_query
def stay_interval_join(t: Proxies) -> DataFrame:
    rows = cohort.stay_recordings(t.records, t.stays)
    return rows.select("subject_id", "stay_id", "study_id", "ecg_time", "icu_intime")


@_query
def lab_label_lookup(t: Proxies) -> DataFrame:
    return lookup(t.labevents, t.d_labitems, "itemid").select("labevent_id", "itemid", "label")


@_query
def labs_full_outer(t: Proxies) -> DataFrame:
    pairs = _labs(t)
    parts = []
    for name in schemas.LAB_LABELS:
        part = nearest_value(pairs.where(F.lower("label") == name), ["study_id"], coherent=False)
        short = name.replace(" ", "_")
        parts.append(C.select_rename(part, {"study_id": "study_id", "valuenum": short, "offset": f"{short}_offset"}))
    return _round(outer_join_all(parts, "study_id"))


@_query
def attach_labels(t: Proxies) -> DataFrame:
    labs = cohort.lab_labels(t.records, t.labevents, t.d_labitems)
    stays = cohort.hosp_labels(t.records, t.stays)
    rows = joins.attach_labels(t.records.select("study_id", "subject_id"), labs, stays)
    rows = _as_double(rows, "hadm_id", "hospital_expire_flag", "icu_expire_flag")
    return _round(rows.toDF(*[c.replace(" ", "_") for c in rows.columns]))


@_query
def scores_to_outcomes(t: Proxies) -> DataFrame:
    rows = lookup(cohort.stay_recordings(t.records, t.stays), t.known_scores, "study_id")
    return _round(rows.select("stay_id", "study_id", "admission_age", "age_pred"))


@_query
def semi_join_multi_ecg(t: Proxies) -> DataFrame:
    rows = _hosp(t)
    several = A.groups_with_max(rows, "stay_id", "ecg_order", 1)
    return keep_keys(rows, several, "stay_id").select("stay_id", "study_id", "ecg_order")


@_query
def nearest_lab(t: Proxies) -> DataFrame:
    of_label = {name: F.lower("label") == name for name in schemas.LAB_LABELS}
    near = cohort.nearest_labs(t.records, t.labevents, t.d_labitems, of_label)
    cells = F.array(*[F.struct(F.lit(n).alias("label"), F.col(n).alias("hit")) for n in of_label])
    long = near.select("study_id", "ecg_time", F.explode(cells).alias("c")).where("c.hit is not null")
    return _round(
        long.select(
            "study_id",
            "c.label",
            "c.hit.labevent_id",
            "c.hit.valuenum",
            C.offset(F.col("c.hit.charttime"), "ecg_time").alias("offset"),
        )
    )


def _done(t: Proxies) -> DataFrame:
    """Recordings of known patients are scored by one model at its current and one at an old version."""
    versions = F.array(
        F.struct(F.lit("cnn-age").alias("model"), F.lit("1").alias("version")),
        F.struct(F.lit("resnet-age").alias("model"), F.lit("1").alias("version")),
    )
    return t.known_scores.select("study_id", F.explode(versions).alias("v")).select("study_id", "v.*")


@_query
def pending_scores(t: Proxies) -> DataFrame:
    return pending(t.records, _done(t), {name: m.version for name, m in _MODELS.items()})


# --- aggregates ----------------------------------------------------------------------------------


@_query
def nearest_lab_coherent(t: Proxies) -> DataFrame:
    return _round(nearest_value(_labs(t), ["study_id", "label"], coherent=True))


@_query
def nearest_lab_first_nonnull(t: Proxies) -> DataFrame:
    return _round(nearest_value(_labs(t), ["study_id", "label"], coherent=False))


@_query
def stays_multi_ecg(t: Proxies) -> DataFrame:
    return A.groups_with_max(_hosp(t), "stay_id", "ecg_order", 1)


@_query
def unique_study_filter(t: Proxies) -> DataFrame:
    firsts = cohort.first_recordings(t.records, t.stays)
    return A.keep_unique(firsts.select("study_id", "stay_id", "hadm_id", "ecg_time"), "study_id")


@_query
def gender_counts(t: Proxies) -> DataFrame:
    rows = cohort.stay_recordings(t.records, t.stays)
    return A.value_counts(A.distinct_rows(rows, ["subject_id", "gender", "admission_age"]), "gender", "n")


@_query
def distinct_subjects(t: Proxies) -> DataFrame:
    return A.count_distinct(cohort.stay_recordings(t.records, t.stays), "subject_id", "n_subjects")


@_query
def distinct_demographics(t: Proxies) -> DataFrame:
    return A.distinct_rows(cohort.stay_recordings(t.records, t.stays), ["subject_id", "gender", "admission_age"])


@_query
def describe_outcomes(t: Proxies) -> DataFrame:
    rows = cohort.stay_recordings(t.records, t.stays).withColumn(
        "ecg_offset", C.offset("ecg_time", "icu_intime")
    )
    cols = ["admission_age", "hospital_expire_flag", "ecg_offset"]
    table = A.describe(cut(rows.select(*cols)), cols, [0.2, 0.4, 0.6, 0.8, 0.9, 0.95, 0.98, 0.99])
    return _round(table, EXACT_DIGITS, mean=6, std=6)


@_query
def visits_per_subject(t: Proxies) -> DataFrame:
    return _round(A.rows_per_key(cut(cohort.stay_recordings(t.records, t.stays).select("subject_id")), "subject_id"))


@_query
def mortality_by_delta_decile(t: Proxies) -> DataFrame:
    """Rates by bins of the error over all stay recordings, first or not."""
    rows = lookup(cohort.stay_recordings(t.records, t.stays), t.known_scores, "study_id").withColumns(
        {"age_delta": C.age_delta(), "icu_mort": C.icu_mort()}
    )
    return _round(outcomes.mortality_by_bin(rows, decimals=9))


@_query
def mortality_of_followed_stays(t: Proxies) -> DataFrame:
    """The same for stays with several recordings."""
    rows = cohort.stay_recordings(t.records, t.stays)
    several = rows.groupBy("stay_id").count().where(F.col("count") > 1)
    followed = lookup(keep_keys(rows, several, "stay_id"), t.known_scores, "study_id")
    return _round(outcomes.mortality_by_bin(followed.withColumns({"age_delta": C.age_delta(), "icu_mort": C.icu_mort()}), decimals=9))


@_query
def quality_profile(t: Proxies) -> DataFrame:
    return _round(A.profile(quality.recording_quality(_split(t), t.signals)))


@_query
def rows_per_split(t: Proxies) -> DataFrame:
    return A.rows_per_source(_split(t), "split")


@_query
def non_null_counts(t: Proxies) -> DataFrame:
    rows = lookup(cohort.with_demographics(t.records, t.patients), t.known_scores, "study_id")
    return A.info(rows)


@_query
def subject_death_share(t: Proxies) -> DataFrame:
    rows = cohort.stay_recordings(t.records, t.stays)
    return _round(A.event_share(rows, "subject_id", "hospital_expire_flag"), 9)


def _scored(t: Proxies) -> DataFrame:
    return lookup(cohort.stay_recordings(t.records, t.stays), t.known_scores, "study_id")


@_query
def age_correlation(t: Proxies) -> DataFrame:
    return _round(metrics.pearson(_scored(t), "admission_age", "age_pred"))


@_query
def age_histogram(t: Proxies) -> DataFrame:
    return bins.histogram(cohort.stay_recordings(t.records, t.stays), "admission_age", 1.0)


@_query
def age_hexbin(t: Proxies) -> DataFrame:
    return _round(bins.hexbin(_scored(t), "admission_age", "age_pred", 30))


@_query
def error_density(t: Proxies) -> DataFrame:
    rows = _scored(t).where("age_pred is not null").withColumn("delta_age", C.age_delta())
    rows = cut(rows.select("admission_age", "delta_age"))
    binned = cut(quantiles.quantile_bin(rows, "admission_age", 5, name="age_bin").select("age_bin", "delta_age"))
    return _round(bins.density(binned, "delta_age", ["age_bin"]))


@_query
def regression_metrics(t: Proxies) -> DataFrame:
    return _round(metrics.regression_metrics(_scored(t), "admission_age", "age_pred", ["gender"]))


@_query
def binary_metrics(t: Proxies) -> DataFrame:
    risk = 1 / (1 + F.exp(-(F.col("age_pred") - 60) / 15))
    rows = _scored(t).withColumn("risk", risk)
    return _round(metrics.binary_metrics(rows, "hospital_expire_flag", "risk", ["gender"]))


@_query
def exact_auc(t: Proxies) -> DataFrame:
    """Predicted age itself as a score of death, to whole years, so that many are equal."""
    rows = _scored(t).withColumn("years", F.round("age_pred"))
    return _round(metrics.exact_auc(rows, "hospital_expire_flag", "years", ["gender"]))


# --- ranking and bins ----------------------------------------------------------------------------


@_query
def ecg_order(t: Proxies) -> DataFrame:
    return _hosp(t).select("stay_id", "study_id", "ecg_time", "ecg_order")


@_query
def first_ecg_per_stay(t: Proxies) -> DataFrame:
    rows = cohort.stay_recordings(t.records, t.stays).select("stay_id", "study_id", "ecg_time")
    return ranking.first_per_group(rows, ["stay_id"], ["ecg_time", "study_id"])


@_query
def age_delta_deciles(t: Proxies) -> DataFrame:
    rows = cut(_delta(t).select("stay_id", "study_id", "age_delta"))
    binned = quantiles.quantile_bin(rows, "age_delta", 10, decimals=9)
    return _round(binned.select("stay_id", "study_id", "age_delta", "bin", "bin_lo", "bin_hi"))


@_query
def lab_quantile_sketches(t: Proxies) -> DataFrame:
    """Quantiles per laboratory item from stored daily sketches, held against the ranks of all values."""
    probs = [0.05, 0.25, 0.5, 0.75, 0.95]
    days = t.labevents.withColumn("day", F.to_date("charttime"))
    stored = cut(quantiles.value_sketches(days, "valuenum", ["itemid", "day"]), "day-sketches")
    found = quantiles.sketch_quantiles(quantiles.merge_sketches(stored, ["itemid"]), probs, ["itemid"])
    asked = F.arrays_zip(F.array(*[F.lit(p) for p in probs]).alias("prob"), F.col("quantiles").alias("value"))
    found = found.select("itemid", "n", F.inline(asked))
    values = t.labevents.where(F.col("valuenum").isNotNull() & ~F.isnan("valuenum"))
    counts = values.groupBy("itemid", F.col("valuenum").alias("x")).agg(F.count(F.lit(1)).alias("rows"))
    ranks = counts.join(found, "itemid").groupBy("itemid", "prob", "n").agg(
        F.sum(F.when(F.col("x") < F.col("value"), F.col("rows")).otherwise(0)).alias("below"),
        F.sum(F.when(F.col("x") <= F.col("value"), F.col("rows")).otherwise(0)).alias("upto"),
    )
    off = F.greatest(F.col("below") - F.col("prob") * F.col("n"), F.col("prob") * F.col("n") - F.col("upto"))
    within = (off <= quantiles.SKETCH_ERROR * F.col("n") + 1).cast("int")
    return ranks.select("itemid", "prob", "n", within.alias("within_bound"))


@_query
def age_quintiles(t: Proxies) -> DataFrame:
    rows = cut(cohort.stay_recordings(t.records, t.stays).select("stay_id", "study_id", "admission_age"))
    binned = quantiles.quantile_bin(rows, "admission_age", 5, decimals=9)
    return _round(binned.select("stay_id", "study_id", "admission_age", "bin", "bin_lo", "bin_hi"))


# --- limits, samples, shuffles -------------------------------------------------------------------


@_query
def epoch_order(t: Proxies) -> DataFrame:
    shards = sampling.number_shards(t.records.select("study_id"), "study_id", rows_per_shard=64, mode="md5")
    return sampling.epoch_order(shards, epoch=3, mode="md5").select("study_id", "shard", "shard_row", "epoch_shard", "epoch_row")


@_query
def first_n_records(t: Proxies) -> DataFrame:
    return sampling.first_n(t.records.select("study_id", "ecg_time"), ["ecg_time", "study_id"], 10)


@_query
def sample_stays(t: Proxies) -> DataFrame:
    rows = cohort.stay_recordings(t.records, t.stays)
    return sampling.sample_groups(rows, "stay_id", 250, mode="md5").select("stay_id", "study_id")


@_query
def epoch_shuffle(t: Proxies) -> DataFrame:
    return sampling.epoch_shuffle(t.records.select("study_id"), "study_id", epoch=3, mode="md5")


# --- unions and reshaping ------------------------------------------------------------------------


@_query
def union_histories(t: Proxies) -> DataFrame:
    parts = {}
    for name in HISTORY_MODELS:
        rows = t.history.where(F.col("model") == name).drop("model")
        parts[name] = rows.drop("mse", "val_mse") if name.endswith("gender") else rows
    return reshape.union_tagged(parts, "model")


@_query
def labs_wide(t: Proxies) -> DataFrame:
    wide = reshape.labels_wide(_labs(t))
    return _round(wide.toDF(*[c.replace(" ", "_") for c in wide.columns]))


@_query
def history_pivot(t: Proxies) -> DataFrame:
    wide = reshape.pivot_metric(t.history, "epoch", "model", "val_mse", HISTORY_MODELS)
    return wide.toDF(*[c.replace("-", "_") for c in wide.columns])


@_query
def history_unpivot(t: Proxies) -> DataFrame:
    return reshape.unpivot_metrics(t.history, ["model", "epoch"], ["loss", "val_loss"])


# --- signals -------------------------------------------------------------------------------------


@_query
def signal_explode(t: Proxies) -> DataFrame:
    rows = S.explode_signal(t.signals, ["file_name"], lead_names=schemas.LEAD_NAMES[:LEADS])
    return _round(rows)


@_query
def lead_stats(t: Proxies) -> DataFrame:
    per_lead = t.signals.select("file_name", F.posexplode(S.lead_stats("signal")).alias("lead", "s"))
    return _round(per_lead.select("file_name", "lead", "s.*"))


@_query
def signal_summary(t: Proxies) -> DataFrame:
    return _round(t.signals.select("file_name", S.signal_summary("signal").alias("s")).select("file_name", "s.*"))


@_query
def signal_flags(t: Proxies) -> DataFrame:
    return signals.flag_bad(t.signals).select("file_name", "any_flat", "any_nan")


@_query
def reject_bad_signals(t: Proxies) -> DataFrame:
    return signals.reject_counts(t.signals)


@_query
def zscore_signal(t: Proxies) -> DataFrame:
    scaled = signals.zscore(signals.reject_bad(t.signals))
    return _round(S.explode_signal(scaled, ["file_name"]))


@_query
def signal_reshape(t: Proxies) -> DataFrame:
    """Flatten, restore, transpose; long form of the transpose."""
    restored = t.signals.select("file_name", S.reshape(S.flatten_signal("signal"), LEADS).alias("signal"))
    turned = restored.select("file_name", S.to_time_major("signal").alias("signal"))
    rows = turned.select("file_name", F.posexplode("signal").alias("i", "leads"))
    return _round(rows.select("file_name", "i", F.posexplode("leads").alias("lead", "value")))


@_query
def augment_noise(t: Proxies) -> DataFrame:
    noisy = S.augment_noise("signal", "file_name", epoch=1, mode="md5")
    rows = t.signals.select("file_name", noisy.alias("signal"))
    return _round(S.explode_signal(rows, ["file_name"]))


@_query
def signal_quality(t: Proxies) -> DataFrame:
    return _round(quality.recording_quality(_split(t), t.signals))


# --- splits, features, scores --------------------------------------------------------------------


@_query
def group_split(t: Proxies) -> DataFrame:
    return splitting.group_split(t.records.select("study_id", "subject_id"), mode="md5")


@_query
def group_split_exact(t: Proxies) -> DataFrame:
    return splitting.group_split_exact(t.records.select("study_id", "subject_id"), mode="md5")


@_query
def split_leaks(t: Proxies) -> DataFrame:
    """Leaks of a faulty split that goes by recording instead of by patient."""
    by_recording = splitting.group_split(t.records.select("study_id", "subject_id"), "study_id", mode="md5")
    return splitting.split_leaks(by_recording)


@_query
def feature_rows(t: Proxies) -> DataFrame:
    return _flat_features(_features(t))


@_query
def feature_rows_bucketed(t: Proxies) -> DataFrame:
    """Signals stored in buckets by recording; the join leaves them where they are."""
    stored = shards.bucketed(t.signals.select("file_name", "signal"), scratch_path(t.spark, "signals"), "file_name", 8)
    labs = cohort.lab_labels(t.records, t.labevents, t.d_labitems)
    return _flat_features(features.build_features(_split(t), stored, labs, cohort.hosp_labels(t.records, t.stays)))


@_query
def task_views(t: Proxies) -> DataFrame:
    path = scratch_path(t.spark, "task-features")
    shards.write_shards(_features(t), path)
    rows = t.spark.read.parquet(path)
    views = {}
    for name in features.TASKS:
        views[name] = features.task_view(rows, name).withColumn("weighted", _weighted()).drop("signal")
    tagged = reshape.union_tagged(views, "task")
    named = tagged.withColumnsRenamed({"gender": "gender_input", "age": "age_input"})
    return _round(_as_double(named, "gender_input"))


@_query
def task_view_training(t: Proxies) -> DataFrame:
    """What a training reader of the task with noise gets in one epoch, from stored feature rows."""
    path = scratch_path(t.spark, "training-features")
    shards.write_shards(_features(t), path)
    view = features.task_view(t.spark.read.parquet(path), "resnet-age2", training=True, epoch=1, noise_mode="md5")
    named = view.withColumn("weighted", _weighted()).drop("signal").withColumnRenamed("gender", "gender_input")
    return _round(_as_double(named, "gender_input"))


@_query
def score_batches(t: Proxies) -> DataFrame:
    sound = signals.reject_bad(t.signals).select("file_name", "signal")
    return _round(scoring.score(sound, _MODELS["cnn-age"]))


@_query
def score_all_models(t: Proxies) -> DataFrame:
    """Models over stored signals; the second append finds nothing to add."""
    sound = signals.reject_bad(t.signals).select(F.col("file_name").alias("study_id"), "signal")
    stored = shards.bucketed(sound, scratch_path(t.spark, "sound-signals"), "study_id", 8)
    path = scratch_path(t.spark, "scores")
    scored = cut(scoring.score_all(stored, _MODELS, _done(t)), "scored")
    score_store.write_scores(scored, path)
    score_store.write_scores(scored, path)
    return _round(score_store.read_scores(t.spark, path))


# --- jobs ----------------------------------------------------------------------------------------


@_query
def job_lab_labels(t: Proxies) -> DataFrame:
    labs = cohort.lab_labels(t.records, t.labevents, t.d_labitems)
    return _round(labs.toDF(*[c.replace(" ", "_") for c in labs.columns]))


@_query
def job_hosp_labels(t: Proxies) -> DataFrame:
    return _round(cohort.hosp_labels(t.records, t.stays))


@_query
def job_split(t: Proxies) -> DataFrame:
    rows = _split(t)
    leaks = splitting.split_leaks(rows).select("subject_id", F.lit(True).alias("leaked"))
    checked = lookup(rows, leaks, "subject_id")
    leaked = F.coalesce("leaked", F.lit(False)).alias("leaked")
    return _as_double(checked.select("study_id", "subject_id", "ecg_age", "split", leaked), "ecg_age")


@_query
def job_features(t: Proxies) -> DataFrame:
    path = scratch_path(t.spark, "features")
    shards.write_shards(_features(t), path)
    return _flat_features(t.spark.read.parquet(path))


@_query
def job_quality(t: Proxies) -> DataFrame:
    profile, sizes = quality.quality_report(quality.recording_quality(_split(t), t.signals))
    counted = sizes.select(F.col("source").alias("column"), F.lit("rows").alias("kind"), F.col("n").cast("double").alias("rate"))
    return _round(profile.unionByName(counted))


@_query
def job_age_mortality(t: Proxies) -> DataFrame:
    return _round(outcomes.age_mortality(t.records, t.stays, t.scores, decimals=9))


@_query
def job_age_over_time(t: Proxies) -> DataFrame:
    rows = outcomes.age_over_time(t.records, t.stays, t.scores, mode="md5")
    return _round(rows.select("stay_id", "study_id", "ecg_delta", "age_delta", "hospital_expire_flag"))


@_query
def job_history(t: Proxies) -> DataFrame:
    return history.history_report(t.spark, _write_histories(t))


__all__ = ["all_queries"]
