"""Mixing of sources to target weights along a curriculum."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import SPACE, bounded, running_total, saved

Schedule = Sequence[tuple[float, float]]

# Relative demand over training time by weight: light sources early, heavy ones late.
SCHEDULES: dict[int, Schedule] = {1: ((0, 1.5), (1, 0.5)), 2: ((0, 1.0), (1, 1.0)), 3: ((0, 0.5), (1, 1.5))}
FLAT: Schedule = ((0, 1.0), (1, 1.0))       # of weights without a schedule
MAX_EPOCHS = 3


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def time_of(share: Column, schedule: Schedule) -> Column:
    """Training time in [0, 1] by which a source has spent ``share`` of its tokens.

    The piecewise linear demand is integrated; its inverse solves a quadratic on the piece that holds ``share``.
    """
    pieces, area = [], 0.0
    for (t0, r0), (t1, r1) in zip(schedule, schedule[1:]):
        pieces.append((t0, t1 - t0, r0, r1, area))
        area += (t1 - t0) * (r0 + r1) / 2
    out = None
    for t0, width, r0, r1, start in reversed(pieces):
        need = share * F.lit(area) - F.lit(start)
        slope = (r1 - r0) / width
        under = F.greatest(F.lit(r0 * r0) + F.lit(2 * slope) * need, F.lit(0.0))
        at = F.lit(float(t0)) + F.lit(2.0) * need / F.greatest(F.lit(float(r0)) + F.sqrt(under), F.lit(1e-12))
        out = at if out is None else F.when(share * F.lit(area) < F.lit(start + width * (r0 + r1) / 2), at).otherwise(out)
    return F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))


def source_targets(sizes: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """One row per source: size, weight, target and where it starts when all sources stand in order.

    The level at which ``least(max_epochs * size, level * weight)`` sums to all words is found by resharing; each
    step is one aggregate over the sources, and only its sums come to the driver.
    """
    sources = saved(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    sources = sources.withColumn("__null", F.col("source").isNull()).withColumn("__one", F.lit(1))
    ranked = running_total(sources, ["__null", "source"], "__one", "__rank")
    ranked = saved(running_total(ranked, ["__null", "source"], "source_size", "__start"), "ranked")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("__rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight)
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, capped = 0.0, -1
    while total:
        full = F.lit(False) if capped < 0 else cap <= F.col("weight") * F.lit(level)
        got = ranked.agg(
            F.count_if(full), F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        if got[0] == capped or not got[2]:
            break
        capped, level = got[0], (total - got[1]) / got[2]
    return ranked.select(
        "source", "source_size", "weight", "__start", F.least(cap, F.col("weight") * F.lit(level)).alias("target")
    )


def mix(
    docs: DataFrame, *, weights: Sequence[int] = (1, 2, 3), schedules: Mapping[int, Schedule] = SCHEDULES,
    max_epochs: int = MAX_EPOCHS, seed: int = 7,
) -> DataFrame:
    """What the mix takes of every document, and when.

    Sources, in code-point order with null last, weigh ``weights`` in turn and share the words of the whole table;
    no source is read more than ``max_epochs`` times. Inside a source documents stand in an order drawn from a hash
    of the id, laid end to end and repeated; the target covers a stretch of that line. A document's copies are the
    parts of it under the stretch, so the last one may be cut to its first words and a source's words meet its target
    to the word. The share of the target spent before a copy, put through the inverse of the source's integrated
    demand, is the copy's training position. Weights without an entry in ``schedules`` are spent evenly.

    Returns one row per input row: doc_id, source, size, source_size, target, taken and ``copies`` (array of
    position and words). Null or empty texts have size 0 and are never taken. Null ids are ordered by their text's
    hash; repeated rows are separate documents. An empty table gives an empty result; other columns are ignored.
    A source may hold any share of the rows: lines are cut by range, not by source.
    """
    sizes = saved(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                    F.xxhash64(F.lit(seed), "doc_id", "source", "text").alias("__mark")),
        "sizes",
    )
    sources = bounded(saved(source_targets(sizes, weights, max_epochs), "targets"))
    order = ["__null", "source", "__mark", "doc_id"]
    line = running_total(sizes.withColumn("__null", F.col("source").isNull()), order, "size", "__at")
    line = line.join(sources.withColumnRenamed("source", "__source"), F.col("source").eqNullSafe(F.col("__source")))
    stop = F.floor(F.col("target") + F.lit(0.5))

    def copy(k: Column) -> Column:
        at = F.col("__at") - F.col("__start") + k * F.col("source_size")
        words = F.least(F.greatest(stop - at, F.lit(0)), F.col("size"))
        share = F.try_divide(at, F.col("target"))
        time = None
        for w, schedule in schedules.items():
            by = time_of(share, schedule)
            time = F.when(F.col("weight") == w, by) if time is None else time.when(F.col("weight") == w, by)
        flat = time_of(share, FLAT)
        time = flat if time is None else time.otherwise(flat)
        return F.struct(time.alias("position"), words.cast("long").alias("words"))

    copies = F.filter(F.transform(F.sequence(F.lit(0), F.lit(max_epochs - 1)), copy), lambda c: c["words"] > 0)
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    return line.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "copies", "__mark"
    )


def training_order(mixed: DataFrame) -> DataFrame:
    """Rows range-sorted by the position of their first copy; rows that are not taken come last."""
    first = F.coalesce(F.get("copies", F.lit(0))["position"], F.lit(2.0))
    return mixed.withColumn("position", first).repartitionByRange("position", "doc_id").sortWithinPartitions(
        "position", "doc_id"
    )


def first_words(text: Column, n: Column) -> Column:
    """The first ``n`` words of a text, one space between them."""
    return F.array_join(F.slice(F.split(F.regexp_replace(text, f"^[{SPACE}]+", ""), f"[{SPACE}]+"), 1, n.cast("int")), " ")


def whole_copies(mixed: DataFrame) -> DataFrame:
    """``mixed`` with whole copies only: one that reaches over its source's target counts if half of it or more fits.

    Taken words of a source then differ from its target by half of one document at most.
    """
    near = F.filter("copies", lambda c: 2 * c["words"] >= F.col("size"))
    copies = F.transform(near, lambda c: F.struct(c["position"].alias("position"), F.col("size").alias("words")))
    return mixed.withColumn("copies", copies).withColumn("taken", F.size("copies") * F.col("size"))


def mixed_documents(docs: DataFrame, *, whole: bool = False, **options) -> DataFrame:
    """The training set of the mix: documents once per copy, by position.

    A copy that reaches over its source's target holds its first words; with ``whole`` it is whole or left out.
    """
    mixed = mix(docs, **options)
    if whole:
        mixed = whole_copies(mixed)
    copies = mixed.select(F.col("doc_id").alias("__id"), "__mark", "size", F.explode("copies").alias("__c"))
    # Repeated rows share a mark; their copies meet one row of them.
    copies = copies.select("__id", "__mark", "size", "__c.words", "__c.position")
    seed = options.get("seed", 7)
    keyed = docs.withColumn("__mark", F.xxhash64(F.lit(seed), "doc_id", "source", "text"))
    once = keyed.dropDuplicates(["doc_id", "__mark"]) if _has_repeats(mixed) else keyed
    cut = F.when(F.col("words") < F.col("size"), first_words(F.col("text"), F.col("words"))).otherwise(F.col("text"))
    joined = once.join(copies, (F.col("doc_id").eqNullSafe(F.col("__id"))) & (once["__mark"] == copies["__mark"]))
    rows = joined.withColumn("text", cut)
    if "n_chars" in docs.columns:
        chars = F.when(F.col("words") < F.col("size"), F.length("text").cast(docs.schema["n_chars"].dataType))
        rows = rows.withColumn("n_chars", F.coalesce(chars, F.col("n_chars")))
    return rows.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id").select(*docs.columns)


def _has_repeats(mixed: DataFrame) -> bool:
    return not mixed.groupBy("doc_id", "__mark").count().where("count > 1").isEmpty()
