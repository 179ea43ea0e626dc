"""Exact duplicates by 128-bit content hash, with bytes compared inside groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import SPACE, bounded, saved

SLICE_ROWS, MOST_SLICES = 200, 1024      # how the rows of one group are dealt to tasks


def normalised(text: Column) -> Column:
    """Runs of ASCII white space become one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACE}]+", " ")


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=content_hash) -> DataFrame:
    """Class of equal normalised texts for every row.

    Returns one row per input row: id, ``keep_id`` (smallest id of its class), ``group_size``, ``kept``,
    ``text_sha256``. Only ids and hashes are grouped. Rows of groups with two or more members then meet
    their group's first text and are compared byte by byte; the few that differ (a hash collision) form
    classes of their own by whole text. ``digest`` exists so that tests can force collisions.

    Null text equals empty text. Null ids sort last: a class made of them only has a null ``keep_id``. When an
    id is repeated, every row with the smallest id is kept. An empty table gives an empty result; other columns
    are ignored. A group may hold any share of the rows: ids and hashes are pre-aggregated before their shuffle, and
    the rows of a large group meet copies of its first text in slices of about ``SLICE_ROWS`` rows, dealt by id (rows that repeat one id, or have none, share a slice).
    """
    docs = docs.select(F.col(id_col).alias("__id"), normalised(F.col(text_col)).alias("__text"))
    marks = saved(
        docs.select("__id", digest(F.col("__text")).alias("__h"), F.sha2(F.col("__text"), 256).alias("text_sha256")),
        "digests",
    )
    groups = marks.groupBy("__h").agg(F.min("__id").alias("__first"), F.count("*").alias("__n"))
    groups = bounded(saved(groups.where("__n > 1"), "groups"))

    members = docs.withColumn("__h", digest(F.col("__text"))).join(groups, "__h")
    slices = F.least(F.lit(MOST_SLICES), F.ceil(F.col("__n") / SLICE_ROWS)).cast("int")
    first = members.where(F.col("__id").eqNullSafe(F.col("__first"))).groupBy("__h").agg(
        F.min("__text").alias("__want"), F.max(slices).alias("__slices"))
    first = saved(first, "first_texts").select("__h", "__want", F.explode(F.sequence(F.lit(0), F.col("__slices") - 1)).alias("__slice"))
    members = members.withColumn("__slice", F.pmod(F.xxhash64(F.lit(5), "__id"), slices).cast("int"))
    others = members.join(first, ["__h", "__slice"]).where(F.col("__text") != F.col("__want"))
    # Rows of a group whose text is not the first one: none, unless two texts share a hash.
    strays = saved(others.groupBy("__h", "__text").agg(F.min("__id").alias("__own"), F.count("*").alias("__m"))
                   .select("__h", F.sha2("__text", 256).alias("text_sha256"), "__own", "__m"), "strays")
    lost = strays.groupBy("__h").agg(F.sum("__m").alias("__lost"))
    # A stray class is told from others of its hash by its second, 256-bit hash.
    return (
        marks.join(groups, "__h", "left")
        .join(bounded(strays), ["__h", "text_sha256"], "left")
        .join(bounded(lost), "__h", "left")
        .select(
            F.col("__id").alias(id_col),
            F.when(F.col("__m").isNotNull(), F.col("__own")).when(F.col("__n").isNotNull(), F.col("__first"))
            .otherwise(F.col("__id")).alias("keep_id"),
            F.coalesce("__m", F.col("__n") - F.coalesce("__lost", F.lit(0)), F.lit(1)).cast("long").alias("group_size"),
            "text_sha256",
        )
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("keep_id")))
    )
