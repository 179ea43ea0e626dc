"""Reproducible shuffle into shards: a Feistel permutation of global row numbers, with cycle walking.

Rows are numbered in one order. A keyed permutation of 0 .. n-1 sends a row number to its place in the shuffle;
shard and slot follow from the place by division. So both can be computed for any row, and the row for any shard and
slot, without the table.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence
from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import running_total, saved

ROUNDS = 6
RESULT = ("doc_id", "size", "text_crc32", "row", "shard", "slot")


@dataclass(frozen=True)
class Permutation:
    """A keyed permutation of 0 .. rows-1.

    A number is written as two digits, below ``high`` and ``low``, each round adds a hash of one digit to the other
    (modulo its base), so that a round can be undone. ``high * low`` exceeds ``rows`` by less than ``high``: the few numbers
    that come out too large are permuted again until they fall inside.
    """

    rows: int
    seed: int = 0

    @property
    def high(self) -> int:
        return isqrt(max(self.rows, 1) - 1) + 1

    @property
    def low(self) -> int:
        return -(-max(self.rows, 1) // self.high)

    @property
    def outside(self) -> int:
        return self.high * self.low - max(self.rows, 1)

    def _once(self, number: Column) -> Column:
        high, low, seed = (F.lit(x).cast("long") for x in (self.high, self.low, self.seed))
        left, right = F.call_function("div", number, low), F.pmod(number, low)
        for turn in range(ROUNDS):
            key = [seed, F.lit(turn).cast("long")]
            if turn % 2:
                right = F.pmod(right + F.pmod(F.xxhash64(*key, left), low), low)
            else:
                left = F.pmod(left + F.pmod(F.xxhash64(*key, right), high), high)
        return left * F.lit(self.low) + right

    def place(self, rows: DataFrame, number: str, into: str) -> DataFrame:
        """``rows`` with the place of each row number.

        A walk meets each number outside at most once, so ``outside`` more steps always suffice. They are taken for the
        numbers that land outside only: about sqrt(rows) of them with up to sqrt(rows) steps each.
        """
        out = rows.withColumn(into, self._once(F.col(number).cast("long")))
        if not self.outside:
            return out
        walked = F.aggregate(
            F.sequence(F.lit(1), F.lit(self.outside)), F.col(into),
            lambda at, _: F.when(at < self.rows, at).otherwise(self._once(at)))
        return out.withColumn(into, F.when(F.col(into) < self.rows, F.col(into)).otherwise(walked))

    def _hash(self, turn: int, digit: int) -> int:
        import xxhash

        state = 42                                            # Spark's seed; every argument seeds the next
        for part in (struct.pack("<q", self.seed), struct.pack("<q", turn), struct.pack("<q", digit)):
            state = xxhash.xxh64_intdigest(part, state)
        return state - (1 << 64) if state >> 63 else state

    def place_of(self, row: int) -> int:
        """The same for one row number, on the driver."""
        at = row
        while True:
            left, right = divmod(at, self.low)
            for turn in range(ROUNDS):
                if turn % 2:
                    right = (right + self._hash(turn, left)) % self.low
                else:
                    left = (left + self._hash(turn, right)) % self.high
            at = left * self.low + right
            if at < self.rows:
                return at

    def row_at(self, place: int) -> int:
        """The row number that has a place: the rounds undone."""
        at = place
        while True:
            left, right = divmod(at, self.low)
            for turn in reversed(range(ROUNDS)):
                if turn % 2:
                    right = (right - self._hash(turn, left)) % self.low
                else:
                    left = (left - self._hash(turn, right)) % self.high
            at = left * self.low + right
            if at < self.rows:
                return at


def locate(row: int, rows: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of a row number, without the table."""
    slot, shard = divmod(Permutation(rows, seed).place_of(row), shards)
    return shard, slot


def row_of(shard: int, slot: int, rows: int, shards: int, seed: int = 0) -> int:
    """The row number at a slot of a shard."""
    return Permutation(rows, seed).row_at(slot * shards + shard)


def dealt(docs: DataFrame, shards: int, *, seed: int = 0, keep: Sequence[str] = ()) -> DataFrame:
    """Every row of ``docs`` with its number, shard and slot.

    Returns one row per input row: doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, row, shard, slot, then the
    columns of ``keep`` (those named like a result column are replaced). Rows are numbered by doc_id, text hash, checksum
    and size; null ids come first, null text counts as empty. Rows that repeat in all of these are interchangeable: they
    share the places that they have, and a last key made from the input's files lets Spark deal any number of them to
    several tasks. Shards differ by one row at most, slots have no gap. An empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = [c for c in keep if c not in RESULT]
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("__text"), F.monotonically_increasing_id().alias("__again"), F.lit(1).alias("__one"),
        *[F.col(c) for c in kept])
    rows = saved(rows, "shard_rows")
    order = Permutation(rows.count(), seed)
    numbered = running_total(rows, ["doc_id", "__text", "text_crc32", "size", "__again"], "__one", "row")
    placed = order.place(numbered, "row", "__place")
    return placed.select(
        "doc_id", "size", "text_crc32", "row", F.pmod("__place", F.lit(shards)).cast("int").alias("shard"),
        F.call_function("div", "__place", F.lit(shards)).alias("slot"), *kept)


def write_shards(docs: DataFrame, path: str, shards: int, *, seed: int = 0) -> None:
    """Whole documents as Parquet, one folder a shard, its files in slot order."""
    rows = dealt(docs, shards, seed=seed, keep=docs.columns)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
