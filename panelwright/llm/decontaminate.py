"""Benchmark decontamination by winnowed fingerprints, extended to exact word windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from panelwright.llm.common import bounded, saved

# Fixed values of the contract: what separates words, and the letters that are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SPAN = 10      # words of a window: every shared run of so many words is found
GRAM = 4       # words of a fingerprint
BLOCK = 128    # words handled at once; neighbouring blocks overlap by a window less one word (256 at most with it)


def words(text: Column) -> Column:
    """Words of a text; null has none. Only A-Z are lower-cased."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, SEPARATORS), "")


def blocks(rows: DataFrame, keys: list[str], span: int) -> DataFrame:
    """Overlapping blocks of ``__words``: each window of ``span`` words lies whole in at least one.

    Long texts become many rows, so that what follows never copies a whole text per fingerprint.
    """
    starts = F.sequence(F.lit(0), F.greatest(F.size("__words") - span, F.lit(0)), F.lit(BLOCK))
    cut = F.transform(starts, lambda s: F.struct(s.alias("at"), F.slice("__words", s + 1, BLOCK + span - 1).alias("words")))
    return rows.select(*keys, F.explode(cut).alias("__b")).select(
        *keys, F.col("__b.at").alias("__at"), F.col("__b.words").alias("__words")
    )


def places(count: Column) -> Column:
    return F.when(count > 0, F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))).otherwise(F.array().cast("array<int>"))


def winnowed(rows: DataFrame, span: int, gram: int) -> DataFrame:
    """Adds ``__p`` and ``__f``: the smallest hash of each ``span - gram + 1`` neighbouring grams, and its place.

    Equal windows keep the same gram wherever they stand, so two texts that share ``span`` words share a kept one.
    Hash and place travel in one long, the place in its low byte: of equal hashes the first is the smallest.
    """
    n, width = F.size("__words"), span - gram + 1
    packed = F.transform(
        places(n - (gram - 1)),
        lambda i: F.xxhash64(*[F.get("__words", i + j) for j in range(gram)]).bitwiseAND(F.lit(~255)).bitwiseOR(i),
    )
    rows = rows.withColumn("__gram", packed)
    picked = F.col("__gram")
    if width > 1:
        picked = F.array_distinct(F.transform(
            places(n - (span - 1)), lambda i: F.least(*[F.get("__gram", i + j) for j in range(width)])))
    return (
        rows.withColumn("__k", F.explode(picked)).drop("__gram")
        .withColumn("__p", F.col("__k").bitwiseAND(F.lit(255)).cast("int"))
        .withColumn("__f", F.col("__k").bitwiseAND(F.lit(~255))).drop("__k")
    )


def around(place: Column, span: int, gram: int) -> Column:
    """The words that windows through a gram at ``place`` can hold."""
    left = F.least(place, F.lit(span - gram))
    return F.slice("__words", place - left + 1, left + span)


def hits_of_length(docs: DataFrame, items: DataFrame, span: int, gram: int) -> DataFrame:
    """Document windows of ``span`` words that equal an item's: ``__row``, ``doc_id``, ``item_id``, first word, length."""
    keep = ["item_id", "__f"]
    index = winnowed(blocks(items, ["item_id"], span), span, gram).select(
        *keep, F.least("__p", F.lit(span - gram)).alias("__ileft"), around(F.col("__p"), span, gram).alias("__iwords")
    )
    index = bounded(saved(index.distinct(), "fingerprints"))
    marks = winnowed(blocks(docs, ["doc_id", "__row"], span), span, gram)
    met = marks.join(index, "__f").select(
        "doc_id", "__row", "item_id", "__at", "__p", "__ileft", "__iwords",
        F.least("__p", F.lit(span - gram)).alias("__left"), around(F.col("__p"), span, gram).alias("__dwords"),
    )
    # Extend: of the windows through the gram, those whose words are all equal. Compared as words, not as hashes.
    back = F.least("__left", "__ileft")

    def equal(k: Column) -> Column:
        mine = F.slice("__dwords", F.col("__left") - back + k + 1, span)
        return (F.size(mine) == span) & (mine == F.slice("__iwords", F.col("__ileft") - back + k + 1, span))

    starts = F.filter(F.sequence(F.lit(0), back), equal)
    return met.withColumn("__k", F.explode(starts)).select(
        "doc_id", "__row", "item_id", (F.col("__at") + F.col("__p") - back + F.col("__k")).alias("__start"),
        F.lit(span).alias("__len"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame, *, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Words of every document that stand in a window shared with a benchmark item.

    A window is ``span`` consecutive item words, or the whole item when it is shorter. Documents and items are
    winnowed with the same parameters and joined on fingerprints; each match is extended to the equal windows
    through it. Every shared window holds a kept fingerprint, so none is missed, and words are compared, so none is
    invented. Items shorter than ``span`` are looked up by the hash of all their words, one pass for each length
    that occurs.

    Returns one row per input row: doc_id, n_words, n_hit, n_items (distinct item ids), items_sha256, contaminated.
    Null texts have no words; repeated rows get equal results; items with null id count as the empty string; an
    empty benchmark hits nothing; other columns are ignored. Frequent fingerprints are joined map-side while the
    benchmark's index is within a counted bound, else by a join whose skewed partitions Spark splits.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
                             words(F.col("text")).alias("__words")).distinct()
    items = saved(items, "items").withColumn("__n", F.size("__words"))
    short = [r[0] for r in items.where((F.col("__n") > 0) & (F.col("__n") < span)).select("__n").distinct().collect()]

    base = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("__row"), words(F.col("text")).alias("__words"))
    found = hits_of_length(base, items.where(F.col("__n") >= span), span, gram)
    for n in sorted(short):      # fewer than `span` lengths
        found = found.unionByName(hits_of_length(base, items.where(F.col("__n") == n), n, n))
    found = saved(found.distinct(), "hits")

    spans = found.select("doc_id", "__row", "__start", (F.col("__start") + F.col("__len")).alias("__end"))
    spans = spans.groupBy("doc_id", "__row", "__start").agg(F.max("__end").alias("__end"))
    before = Window.partitionBy("doc_id", "__row").orderBy("__start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("__end") - F.greatest("__start", F.coalesce(F.max("__end").over(before), F.lit(0)))
    hit = spans.select("doc_id", "__row", F.greatest(fresh, F.lit(0)).alias("__new")).groupBy("doc_id", "__row").agg(
        F.sum("__new").cast("long").alias("n_hit"))
    named = found.select(F.col("doc_id").alias("__id"), F.col("__row").alias("__mark"), "item_id").distinct()
    named = named.groupBy("__id", "__mark").agg(F.array_sort(F.collect_list("item_id")).alias("__items"))
    marked = named.join(hit, (F.col("__row") == F.col("__mark")) & F.col("doc_id").eqNullSafe(F.col("__id")))
    marked = saved(marked.select("__id", "__mark", "n_hit", "__items"), "marked")

    listed = F.coalesce("__items", F.array().cast("array<string>"))
    return (
        base.select("doc_id", "__row", F.size("__words").cast("long").alias("n_words"))
        .join(bounded(marked), (F.col("__row") == F.col("__mark")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left")
        .select(
            "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.size(listed).cast("long").alias("n_items"),
            F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), F.col("__row").alias("row_hash"),
        )
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Documents without a hit, with their own columns."""
    marks = contamination(docs, benchmark, **options).where("contaminated").select("doc_id", "row_hash").distinct()
    marks = bounded(saved(marks.withColumnRenamed("doc_id", "__id"), "contaminated"))
    keyed = docs.withColumn("__row", F.xxhash64("doc_id", "text"))
    return keyed.join(
        marks, (F.col("__row") == F.col("row_hash")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left_anti"
    ).select(*docs.columns)
