"""Filter interaction audit as an incremental stream with retractions.

Files arrive as available-now micro-batches. A row's own filters depend on its text alone; whether it repeats a smaller
id's text can change as long as rows arrive. So the state of each text is its smallest id so far: a row under it
counts as a repeat at once, and when a smaller id arrives, the row that was smallest until then is taken back from
the counters and counted again as a repeat. What all changes sum up to is the table's counters, and the report follows
from them alone.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import permutations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from panelwright.llm.common import bounded, python_batches, saved
from panelwright.session import scratch_path

FILTERS = "ABCDE"
REPEAT = 1 << FILTERS.index("E")
BUCKET_ROWS = 1024       # rows of the table for each state value
IN_MEMORY = 16_000       # state values, of some 60 kB, up to which they may stay in the executors' memory
# Beyond that, state on the executors' disks, of which only changes go to the checkpoint. Spark takes 4 MB a partition for it.
ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
MICRO_BATCHES = 4        # micro-batches that the files of a table are dealt to
LEAST_WORDS = 200
SYMBOLS, CAPITALS = b"#$%&*|", bytes(range(ord("A"), ord("Z") + 1))


def own_mask(text: bytes, chars: int) -> int:
    """Bits of the filters A to D that a text fails; words and their equality are those of its UTF-8 bytes."""
    words = text.split()                                      # of bytes: at ASCII white space only
    return (
        (len(words) < LEAST_WORDS) << 0
        | (100 * len(set(words)) < 50 * len(words)) << 1
        | (100 * (len(text) - len(text.translate(None, CAPITALS))) > 3 * chars) << 2
        | (len(text.translate(None, SYMBOLS)) < len(text)) << 3
    )


def masked(docs: DataFrame) -> DataFrame:
    """doc_id, part, key (128-bit hash of the text) and mask of every row of a stream or a table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(2), "")
            raw = texts.cast(pa.binary()).to_pylist()
            masks = [own_mask(t, n) for t, n in zip(raw, pc.utf8_length(texts).to_pylist())]
            keys = [hashlib.blake2b(t, digest_size=16).digest() for t in raw]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.fill_null(batch.column(1), ""), pa.array(keys, pa.binary()), pa.array(masks, pa.int32())],
                ["doc_id", "part", "key", "mask"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("part"), "text")
    return rows.mapInArrow(run, "doc_id long, part string, key binary, mask int")


COLUMNS = ["settled", "key", "doc_id", "part", "mask", "good", "toxic", "n"]
CHANGE = "part string, mask int, good boolean, toxic boolean, n long"


def first_of_batch(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows of a batch aggregated by text, before the shuffle to its state.

    Of each text only rows with the batch's smallest id ask for the state, equal ones as one row with their count.
    Others are repeats whatever comes: they, and rows without an id, which are compared with nothing, are settled.
    Settled counts travel along in any bucket and touch no state.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = list(zip(*(c.to_pylist() for c in batch.columns)))
            least: dict[bytes, int] = {}
            for doc_id, _, key, *_ in groups:
                if doc_id is not None and doc_id < least.get(key, doc_id + 1):
                    least[key] = doc_id
            asking: Counter = Counter()
            settled: Counter = Counter()
            for doc_id, part, key, mask, good, toxic in groups:
                if doc_id is None:
                    settled[part, mask, good, toxic] += 1
                elif doc_id > least[key]:
                    settled[part, mask | REPEAT, good, toxic] += 1
                else:
                    asking[key, doc_id, part, mask, good, toxic] += 1
            task = TaskContext.get().partitionId()
            out = [(key, False, doc_id, part, mask, good, toxic, n) for (key, doc_id, part, mask, good, toxic), n in asking.items()]
            out += [(repr((task, *row)).encode(), True, 0, *row, n) for row, n in settled.items()]
            types = [pa.binary(), pa.bool_(), pa.int64(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.int64()]
            columns = zip(*out) if out else [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             ["key", "settled", "doc_id", "part", "mask", "good", "toxic", "n"])

    rows = rows.select("doc_id", "part", "key", "mask", "good", "toxic")
    firsts = rows.mapInArrow(run, f"key binary, settled boolean, doc_id long, {CHANGE}")
    return firsts.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))


def unpacked(state: GroupState) -> dict[bytes, list]:
    """Of each text of a bucket: its smallest id, its own mask, and how many rows of (part, good, toxic) have that id."""
    texts: dict[bytes, list] = {}
    if state.exists:
        held = pa.ipc.open_stream(state.get[0]).read_all()
        for key, least, own, part, good, toxic, n in zip(*(c.to_pylist() for c in held.columns)):
            texts.setdefault(key, [least, own, {}])[2][part, good, toxic] = n
    return texts


def packed(texts: dict[bytes, list]) -> tuple[bytes]:
    rows = [(key, least, own, *who, n) for key, (least, own, held) in texts.items() for who, n in held.items()]
    types = [pa.binary(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_(), pa.int64()]
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["key", "least", "own", "part", "good", "toxic", "n"])
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return (out.getvalue().to_pybytes(),)


def changes(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Counter changes of the texts of one bucket."""
    out: Counter = Counter()
    texts, moved = unpacked(state), False
    for frame in frames:
        for settled, text, doc_id, part, mask, good, toxic, n in zip(*(frame[c].tolist() for c in COLUMNS)):
            if settled:
                out[part, mask, good, toxic] += n
                continue
            known = texts.get(text)
            if known is not None and doc_id > known[0]:
                out[part, mask | REPEAT, good, toxic] += n
                continue
            if known is None or doc_id < known[0]:
                for (p, g, t), k in known[2].items() if known else ():    # no longer the smallest: retract, count as repeats
                    out[p, known[1], g, t] -= k
                    out[p, known[1] | REPEAT, g, t] += k
                known = texts[text] = [doc_id, mask, {}]
            out[part, mask, good, toxic] += n
            known[2][part, good, toxic] = known[2].get((part, good, toxic), 0) + n
            moved = True
    if moved:
        state.update(packed(texts))
    rows = [(*row, n) for row, n in out.items() if n]
    if rows:
        yield pd.DataFrame(rows, columns=["part", "mask", "good", "toxic", "n"])


def marks(labels: DataFrame) -> DataFrame:
    """doc_id, good, toxic: one row an id, whatever one of its label rows says holds."""
    said = [F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))]
    return labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*said)


def counters(docs: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """(part, mask, good, toxic, n) of a stream of documents read to its end; ``labels`` is a table.

    The states of texts that share a bucket of their hash are stored as one value, since a call into Python costs
    more than the work on a text.
    """
    spark = docs.sparkSession
    python_batches(spark, 10_000, "16m")
    known = bounded(saved(marks(labels), "marks"))
    rows = masked(docs).join(known, "doc_id", "left").fillna(False, ["good", "toxic"])
    asked = first_of_batch(rows, buckets).groupBy("bucket").applyInPandasWithState(
        changes, CHANGE, "texts binary", "append", GroupStateTimeout.NoTimeout)
    path = scratch_path(spark, "mask_changes")
    for key, value in ON_DISK.items() if buckets > IN_MEMORY else ():
        spark.conf.set(key, value)
    query = asked.writeStream.format("parquet").outputMode("append").trigger(availableNow=True) \
        .option("checkpointLocation", scratch_path(spark, "mask_state")).option("path", path).start()
    query.awaitTermination()
    found = spark.read.schema(asked.schema).parquet(path)
    return saved(found.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n")).where("n != 0"), "counters")


def file_stream(spark: SparkSession, path: str, micro_batches: int = MICRO_BATCHES) -> DataFrame:
    """A Parquet table as a stream of its files, in about ``micro_batches`` equal shares."""
    still = spark.read.parquet(path)
    files = max(1, -(-len(still.inputFiles()) // micro_batches))
    path = path.rstrip("/")
    same = f"{path[:-1]}[{path[-1]}]"     # a pattern for this path: a stream takes a pattern, not a path, if that is one file
    return spark.readStream.schema(still.schema).option("maxFilesPerTrigger", files).parquet(same)


def report(counts: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from the counters."""
    bit = {f: 1 << i for i, f in enumerate(FILTERS)}
    met = counts.withColumn("filter_order", F.explode(F.lit(["".join(order) for order in permutations(FILTERS)])))
    met = met.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    at = lambda f: F.instr("filter_order", f)
    met = met.withColumn("letter", F.col("filter_order").substr(F.col("step"), F.lit(1)))
    met = met.withColumn("bit", sum((F.when(at(f) == F.col("step"), b).otherwise(0) for f, b in bit.items()), F.lit(0)))
    met = met.withColumn("before", sum((F.when(at(f) < F.col("step"), b).otherwise(0) for f, b in bit.items()), F.lit(0)))
    fails, gone = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) != 0
    count = lambda *conditions: F.coalesce(F.sum(F.when(_all(conditions), F.col("n"))), F.lit(0)).cast("long")
    rows = met.groupBy("part", "filter_order", "step", "letter").agg(
        count(~fails, ~gone).alias("kept"), count(fails, ~gone).alias("removed"), count(fails, gone).alias("redundant"),
        count(F.col("mask") == F.col("bit")).alias("unique_fails"),
        count(fails, ~gone, F.col("good")).alias("good_lost"), count(fails, ~gone, F.col("toxic")).alias("toxic_lost"))
    shares = rows.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return rows.join(shares, ["part", "letter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _all(conditions: Iterable[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def buckets_of(rows: int) -> int:
    """Buckets for a table of about so many rows."""
    return max(1, -(-rows // BUCKET_ROWS))


def audit(docs: DataFrame, labels: DataFrame, *, buckets: int = 4096) -> DataFrame:
    """Interaction of five filters over a stream of documents: what each removes, in each of their 120 orders.

    Filters: A under 200 words, B under half of the words distinct, C over 3% capitals, D a symbol, E text equal to that
    of a smaller doc_id. Returns one row per part (value of lang), filter_order and step, zeros included: kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley.

    Null text is empty, null lang the part of the empty string. A row without an id is compared with no other one. Rows
    that repeat an id and its text are not repeats of each other; a label row repeated with other values counts as good
    or toxic if one of them says so. An empty table gives an empty result; other columns are ignored. Texts are
    compared by 128-bit hash. Rows of one text are aggregated in each batch before they go to its state, so any share
    of the rows may be copies of one text. The state of a text is as small for a long text as for a short one;
    ``buckets`` says in how many values the states are stored, see ``buckets_of``.
    """
    return report(counters(docs, labels, buckets))
