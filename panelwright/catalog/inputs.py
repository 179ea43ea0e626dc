"""Named inputs of the catalog queries: panel shapes over a test-data folder."""

from __future__ import annotations

import functools
import zlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.operators.metrics import score_table
from panelwright.plans import scoring
from panelwright.plans.windows import YEAR_SPLITS, Split, modeling_frame
from panelwright.session import shared_dir
from panelwright.sources import standins, tables

C = F.col
VISIBLE = 250            # stand-in scale of the 1,000-impression visibility rule
CLIENT_FLOOR = 30        # stand-in scale of the 300-page client floor
SINGLE = Split("single", ("2000",), "2001", "year")
KS = [10, 50, 100, 500, 1000, 5000]


def store_path(spark: SparkSession, sf: str, name: str) -> str:
    """Where a derived table of this session and data folder is kept."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/panelwright/{app}-{zlib.crc32(sf.encode()):08x}/{name}"


def stored(name: str):
    """Write the derived table once per session and read it back afterwards.

    The frame and the scored tables are the small results of the heavy scans;
    everything downstream reads them several times.
    """

    def wrap(build):
        @functools.wraps(build)
        def read(spark: SparkSession, sf: str, *args) -> DataFrame:
            path = store_path(spark, sf, "-".join([name, *map(str, args)]))
            if not tables.path_exists(spark, f"{path}/_SUCCESS"):
                return tables.materialize(build(spark, sf, *args), path)
            return spark.read.parquet(path)

        return read

    return wrap


def fact(spark: SparkSession, sf: str, split: Split | None = None) -> DataFrame:
    if split is None:
        return standins.fact_daily(spark, sf)
    rows = standins.fact_daily(spark, sf, str(split.start_date), str(split.end_date))
    return standins.with_clients(rows, spark, sf)


def dim(spark, sf):
    return standins.dim_content(spark, sf)


def split_of(name: str) -> Split:
    return SINGLE if name == "single" else YEAR_SPLITS[name]


def build_frame(spark, sf, name: str = "dev") -> DataFrame:
    split = split_of(name)
    return modeling_frame(fact(spark, sf, split), dim(spark, sf), split)


@stored("frame")
def _frame(spark, sf, name):
    return build_frame(spark, sf, name)


def frame(spark, sf, name: str = "dev") -> DataFrame:
    return _frame(spark, sf, name)


@stored("scored")
def _scored(spark, sf, name):
    base = frame(spark, sf, name)
    frozen = scoring.frozen_rule(base, VISIBLE).withColumn("risk", C("baseline_score") / 8)
    variant = scoring.variant_rule(base, VISIBLE).select("content_hash_id", "variant_score")
    return frozen.join(variant, "content_hash_id")


def scored(spark, sf, name: str = "dev") -> DataFrame:
    """Frame with frozen and variant rule; risk is the frozen score over its
    maximum, a deterministic stand-in for a model probability."""
    return _scored(spark, sf, name)


@stored("pages")
def pages(spark, sf):
    return standins.page_table(spark, sf)


@stored("prepared")
def prepared(spark, sf):
    return scoring.prepare_pages(pages(spark, sf))


def stand_in_probability():
    return F.least(C("days_since_last_update") / 1200.0, F.lit(1.0))


@stored("baseline")
def baseline(spark, sf) -> DataFrame:
    return scoring.with_baseline_codes(scoring.baseline_scores(prepared(spark, sf)))


def predictions(spark, sf) -> DataFrame:
    return prepared(spark, sf).select("content_id", stand_in_probability().alias("best_model_probability"))


CONTEXT = ["content_type", "main_intent", "competition_level", "age_tier", "freshness_tier"]


@stored("final")
def final(spark, sf) -> DataFrame:
    context = prepared(spark, sf).select("content_id", *CONTEXT)
    return scoring.final_queue(baseline(spark, sf).drop(*CONTEXT), predictions(spark, sf), context)


def scores(spark, sf, name: str = "dev") -> DataFrame:
    return score_table(
        scored(spark, sf, name), "content_hash_id", "client_hash_id", "is_position_decline",
        {"frozen_rule": "baseline_score", "variant_rule": "variant_score"},
    )


def risk_scores(spark, sf, name: str = "dev") -> DataFrame:
    return score_table(
        scored(spark, sf, name), "content_hash_id", "client_hash_id", "is_position_decline", {"risk": "risk"}
    )


def stored_fact(spark, sf) -> str:
    """Root of the fact written once per session, partitioned by month."""
    root = store_path(spark, sf, "fact")
    if not tables.path_exists(spark, f"{root}/_SUCCESS"):
        tables.write_fact(fact(spark, sf), root, mode="overwrite")
    return root
