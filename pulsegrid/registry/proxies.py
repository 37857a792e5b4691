"""Clinical stand-ins derived from the driver tables; synthetic, without medical meaning."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# An invented pairing of item ids and labels.
LAB_ITEMS = (
    (50971, "Potassium"),
    (52610, "Potassium"),
    (50983, "Sodium"),
    (52623, "Sodium"),
    (51002, "Troponin I"),
    (52642, "Troponin I"),
)

LEADS = SAMPLES = 8


class Proxies:
    """The tables at one scale, as lazy DataFrames. Each is built from whole driver tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{table}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        return self.raw("events")

    @cached_property
    def patients(self) -> DataFrame:
        return self.raw("customer").where("c_mktsegment <> 'MACHINERY'").selectExpr(
            "c_custkey as subject_id",
            "case when c_custkey % 2 = 0 then 'M' else 'F' end as gender",
            "18 + (c_custkey * 7) % 79 as anchor_age",
            "2024 - c_custkey % 5 as anchor_year",
        )

    @cached_property
    def records(self) -> DataFrame:
        return self.events.where("event_type = 'view'").selectExpr(
            "user_id as subject_id", "event_id as study_id", "event_id as file_name", "ts as ecg_time"
        )

    @cached_property
    def labevents(self) -> DataFrame:
        item = """case event_type when 'click' then if(event_id % 2 = 0, 50971, 52610)
            when 'purchase' then if(event_id % 2 = 0, 50983, 52623)
            when 'error' then if(event_id % 2 = 0, 51002, 52642) else 99999 end"""
        return self.events.where("event_type <> 'view'").selectExpr(
            "user_id as subject_id",
            "ts as charttime",
            f"{item} as itemid",
            "if(event_id % 5 = 0, null, value) as valuenum",
            "'mEq/L' as valueuom",
            "event_id as labevent_id",
        )

    @cached_property
    def d_labitems(self) -> DataFrame:
        # An inline table has a known size, so Spark broadcasts it by its own size check.
        rows = ", ".join(f"({item}, '{label}')" for item, label in LAB_ITEMS)
        return self.spark.sql(f"select * from values {rows} as v(itemid, label)")

    @cached_property
    def stays(self) -> DataFrame:
        return self.events.where("event_type = 'signup'").selectExpr(
            "user_id as subject_id",
            "event_id as hadm_id",
            "event_id as stay_id",
            "case when user_id % 2 = 0 then 'M' else 'F' end as gender",
            "18 + (user_id * 7) % 79 as admission_age",
            "ts - interval 6 hour as admittime",
            "ts + interval 48 hour as dischtime",
            "ts as icu_intime",
            "ts + interval 1 hour * cast(floor(value) as int) as icu_outtime",
            "if(event_id % 7 = 0, 1, 0) as hospital_expire_flag",
        )

    @cached_property
    def n_vectors(self):
        """Number of embeddings, as a scalar subquery."""
        return self.raw("embeddings").agg(F.count(F.lit(1)).alias("n")).scalar()

    @cached_property
    def scores(self) -> DataFrame:
        first = self.raw("embeddings").select("vec_id", F.element_at("embedding", 1).cast("double").alias("x"))
        records = self.records.withColumn("vec_id", F.col("study_id") % self.n_vectors)
        return records.join(first, "vec_id").selectExpr(
            "study_id", "18 + (subject_id * 7) % 79 + 40 * x as age_pred"
        )

    @cached_property
    def known_scores(self) -> DataFrame:
        """Scores of patients with demographics only, so that some recordings have none."""
        known = self.records.join(self.patients.select("subject_id"), "subject_id", "left_semi")
        return self.scores.join(known.select("study_id"), "study_id", "left_semi")

    @cached_property
    def vector_signals(self) -> DataFrame:
        """One 8 x 8 signal per embedding; some with a flat lead, some with a NaN sample."""
        sample = f"""transform(sequence(0, {LEADS - 1}), l -> transform(sequence(0, {SAMPLES - 1}), i -> case
            when vec_id % 17 = 0 and l = 0 then 1D when vec_id % 19 = 0 and l = 3 and i = 2 then double('NaN')
            else cast(element_at(embedding, l * {SAMPLES} + i + 1) as double) end))"""
        return self.raw("embeddings").selectExpr("vec_id", "500 as fs", f"{sample} as signal")

    @cached_property
    def signals(self) -> DataFrame:
        """One signal per recording."""
        records = self.records.select("file_name", (F.col("file_name") % self.n_vectors).alias("vec_id"))
        return records.join(self.vector_signals, "vec_id").select("file_name", "fs", "signal")

    @cached_property
    def history(self) -> DataFrame:
        model = """case event_type when 'click' then 'cnn-age' when 'purchase' then 'cnn-sodium'
            when 'error' then 'resnet-age2' when 'signup' then 'resnet-gender' else 'transformer-age' end"""
        held_out = "case when event_id % 3 = 0 then value end"
        rows = self.events.selectExpr(
            f"{model} as model", "day(ts) - 1 as epoch", "value", f"{held_out} as val", "event_id"
        )
        return rows.groupBy("model", "epoch").agg(
            F.round(F.avg("value"), 6).alias("loss"),
            F.round(F.avg("val"), 6).alias("val_loss"),
            F.round(F.avg(F.expr("value * value")), 7).alias("mse"),
            F.round(F.avg(F.expr("val * val")), 7).alias("val_mse"),
        )


# The model names of the histories.
HISTORY_MODELS = ("cnn-age", "cnn-sodium", "resnet-age2", "resnet-gender", "transformer-age")
