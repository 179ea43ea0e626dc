"""Forests of deep trees. Spark ML grows the trees of a forest together, level by level, and passes over the rows again for
every group of nodes: thirty levels of small nodes are hundreds of jobs. Here the rows are cut into bins once, in Spark, and
dealt to tasks that grow whole trees from bags of their own, so that a forest is one job. What a tree is stays as in Spark
ML: Poisson bags, at most 32 bins a number, sqrt of the features drawn for each node, Gini gain, bag rows a leaf, depth.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwright.session import scratch_path, ship_package
from panelwright.sources.tables import materialize

C = F.col
DEEP = 12                    # trees of more levels are grown here
TREE_BYTES = 1 << 28         # binned training rows at most, which every task holds; beyond, Spark ML grows the forest
BAG_ROWS = 1 << 23           # training rows at most: counts of a bag are packed into 24 bits
BINS = 32
TASKS_PER_CORE = 2
GROUP_BYTES = 1 << 26        # stored trees, about, that a scoring task holds
LEVEL_ROWS = 1 << 15         # rows and cells of a level that are worked on together
LEVEL_CELLS = 1 << 16
GATHER, CACHED = 3, 1 << 20  # rows are moved beside those of their node each so many levels, beyond so many bytes
SHIFT, MASK = 24, (1 << 24) - 1
TREE = "tree int, nodes int, codes binary, votes binary, shares array<double>"


def suits(forest: RandomForestClassifier, vectors: DataFrame, rows: int) -> bool:
    """Deep trees over rows that a task can hold, with the settings that are known here."""
    known = forest.getFeatureSubsetStrategy() == "sqrt" and forest.getImpurity() == "gini" and forest.getMaxBins() == BINS
    plain = forest.getSubsamplingRate() == 1.0 and forest.getMinInfoGain() == 0.0 and forest.getMinWeightFractionPerNode() == 0.0
    few = rows * width(vectors) <= TREE_BYTES and rows <= BAG_ROWS
    return known and plain and few and forest.getBootstrap() and forest.getNumTrees() > 1 and forest.getMaxDepth() > DEEP


def attributes(vectors: DataFrame) -> dict[str, list[dict]]:
    return vectors.schema["features"].metadata["ml_attr"]["attrs"]


def width(vectors: DataFrame) -> int:
    return sum(map(len, attributes(vectors).values()))


def prepare(spark: SparkSession) -> None:
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "64m")


# ---- one tree ------------------------------------------------------------------------

def best_splits(flat, wide, rows, mass, starts, drawn, bins, totals, leaf, weights):
    """Score, feature, cut and left total of the best split of each node. ``rows`` lie node by node from ``starts`` on;
    ``mass`` and totals pack the bag's rows of class 1 over those of both."""
    nodes, m = drawn.shape
    cells = bins[drawn]
    ends = np.cumsum(cells.reshape(-1))
    first = (ends - cells.reshape(-1)).reshape(nodes, m)
    owner = np.repeat(np.arange(nodes), np.diff(starts))
    counts = np.zeros(ends[-1])
    for at in range(0, len(rows), LEVEL_ROWS):
        node = owner[at:at + LEVEL_ROWS]
        place = drawn[node]
        place += (rows[at:at + LEVEL_ROWS] * wide)[:, None]
        key = first[node]
        key += flat.take(place, mode="clip")
        counts += np.bincount(key.reshape(-1), np.repeat(mass[at:at + LEVEL_ROWS], m), ends[-1])
    left = np.cumsum(counts.astype(np.int64))
    left -= np.repeat(np.concatenate([[0], left])[first.reshape(-1)], cells.reshape(-1))
    per_node = cells.sum(axis=1)
    right = np.repeat(totals, per_node) - left
    score = purity(left, weights) + purity(right, weights)
    score[((left & MASK) < leaf) | ((right & MASK) < leaf)] = -np.inf
    begins = first[:, 0]
    best = np.maximum.reduceat(score, begins)
    hits = np.flatnonzero(score == np.repeat(best, per_node))
    _, at = np.unique(np.searchsorted(begins, hits, "right"), return_index=True)
    cell = hits[at]
    pair = np.searchsorted(first.reshape(-1), cell, "right") - 1
    return best, drawn.reshape(-1)[pair], cell - first.reshape(-1)[pair], left[cell]


def purity(packed: np.ndarray, weights: tuple[float, float]) -> np.ndarray:
    """Weight times (1 - Gini impurity) of packed counts."""
    ones = packed >> SHIFT
    rest = ((packed & MASK) - ones) * weights[0]
    ones = ones * weights[1]
    total = ones + rest
    return (ones * ones + rest * rest) / np.maximum(total, 1e-300)


def grow_tree(binned, labels, bins, weights, depth, leaf, draw, rng):
    """(codes, votes, shares) of one tree over the rows of ``binned``. A code packs left child, feature and cut: rows of a
    larger bin than the cut go to the node after the left child; a leaf is its own left child. A vote is the share of
    class 1. Shares are the gains by feature, adding up to 1 if the tree splits at all."""
    n, wide = binned.shape
    flat = binned.reshape(-1)
    bag = rng.poisson(1.0, n)
    rows = np.flatnonzero(bag)
    mass = bag[rows] * (1.0 + labels[rows] * float(1 << SHIFT))
    starts, totals = np.array([0, len(rows)]), np.array([int(mass.sum())])
    codes, votes, shares, before = [], [], np.zeros(wide), 0
    for level in range(depth + 1):
        ones, both = totals >> SHIFT, totals & MASK
        weight = ones * weights[1] + (both - ones) * weights[0]
        votes.append(ones * weights[1] / np.maximum(weight, 1e-300))
        code = ((before + np.arange(len(totals))) << 24) | 255
        codes.append(code)
        before += len(totals)
        open_ = np.flatnonzero((both >= 2 * leaf) & (ones > 0) & (ones < both)) if level < depth else np.zeros(0, int)
        if not len(open_):
            break
        rows, mass, starts = kept(rows, mass, starts, open_)
        if level % GATHER == 0 and len(rows) * wide > CACHED:       # rows of a node lie together again
            flat, rows = flat.reshape(-1, wide)[rows].reshape(-1), np.arange(len(rows))
        drawn = np.argpartition(rng.random((len(open_), wide)), draw - 1, axis=1)[:, :draw] if draw < wide else np.tile(np.arange(wide), (len(open_), 1))
        found = []
        for a, b in parts(starts, bins[drawn].sum(axis=1)):
            lo, hi = starts[a], starts[b]
            found.append(best_splits(flat, wide, rows[lo:hi], mass[lo:hi], starts[a:b + 1] - lo, drawn[a:b], bins, totals[open_[a:b]], leaf, weights))
        best, feature, cut, left = (np.concatenate(c) for c in zip(*found))
        gain = best - purity(totals[open_], weights)
        split = np.flatnonzero(gain > 1e-9)
        if not len(split):
            break
        rows, mass, starts = kept(rows, mass, starts, split)
        feature, cut, left, at = feature[split], cut[split], left[split], open_[split]
        shares += np.bincount(feature, gain[split], wide)
        code[at] = ((before + 2 * np.arange(len(split))) << 24) | (feature << 8) | cut
        rows, mass, starts = halved(flat, wide, rows, mass, starts, feature, cut)
        totals = np.stack([left, totals[at] - left], axis=1).reshape(-1)
    return np.concatenate(codes), np.concatenate(votes), shares / (shares.sum() or 1.0)


def kept(rows, mass, starts, nodes):
    """The rows of some nodes."""
    sizes = np.diff(starts)
    if len(nodes) < len(sizes):
        stay = np.zeros(len(sizes), bool)
        stay[nodes] = True
        stay = np.repeat(stay, sizes)
        rows, mass = rows[stay], mass[stay]
    return rows, mass, np.concatenate([[0], np.cumsum(sizes[nodes])])


def halved(flat, wide, rows, mass, starts, feature, cut):
    """Rows ordered by the children of their nodes, and where these begin."""
    sizes = np.diff(starts)
    right = flat.take(rows * wide + np.repeat(feature, sizes), mode="clip") > np.repeat(cut, sizes)
    rights = np.concatenate([[0], np.cumsum(right)])
    more = np.diff(rights[starts])                                  # rows of each node that go right
    before = rights[:-1] - np.repeat(rights[starts[:-1]], sizes)    # of its node, before each row
    place = np.where(right, np.repeat(starts[1:] - more, sizes) + before, np.arange(len(rows)) - before)
    out, weighed = np.empty_like(rows), np.empty_like(mass)
    out[place], weighed[place] = rows, mass
    return out, weighed, np.concatenate([[0], np.cumsum(np.stack([sizes - more, more], axis=1).reshape(-1))])


def parts(starts, cells) -> Iterator[tuple[int, int]]:
    """Ranges of nodes with about as many rows and cells as are worked on together; a large node is one of its own."""
    load = np.maximum(np.cumsum(np.diff(starts)) // LEVEL_ROWS, np.cumsum(cells) // LEVEL_CELLS)
    cuts = np.flatnonzero(np.diff(load)) + 1
    return zip([0, *cuts], [*cuts, len(load)])


def vote(binned: np.ndarray, codes: np.ndarray, votes: np.ndarray) -> np.ndarray:
    """The vote of one tree for each row."""
    n, wide = binned.shape
    flat, node, at, step = binned.reshape(-1), np.zeros(n, np.int64), np.arange(n), 0
    out = np.zeros(n, np.int64)
    here = at * wide
    while len(at):
        code = codes[node]
        then = (code >> 24) + (flat.take(here + ((code >> 8) & 0xFFFF)) > (code & 255))
        step += 1
        if step % 4 == 0:
            done = then == node
            out[at[done]] = node[done]
            live = ~done
            at, here, then = at[live], here[live], then[live]
        node = then
    return votes[out]


# ---- forests ---------------------------------------------------------------------------

def looked_at(vectors: DataFrame) -> tuple[list[np.ndarray], tuple[float, float] | None]:
    """Where each feature is cut, and the weights of the two classes; None if there are others or weights differ within one.

    A feature is cut between all its values if they are few, else at quantiles.
    """
    groups = attributes(vectors)
    binary = {a["idx"] for a in groups.get("binary", [])}
    cuts = [np.array([0.5]) if i in binary else np.zeros(0) for i in range(width(vectors))]
    numbers = [i for i in range(len(cuts)) if i not in binary]
    values = vectors.select("label", "weight", vector_to_array("features").alias("v"))
    shares = F.array(*[F.lit(k / BINS) for k in range(1, BINS)])
    weight = lambda k: F.when(C("label") == k, C("weight"))
    found = values.agg(
        *[x for i in numbers for x in (F.percentile_approx(C("v")[i], shares, 10_000), F.approx_count_distinct(C("v")[i], 0.05))],
        *[f(weight(k)) for k in (0.0, 1.0) for f in (F.min, F.max)],
        F.count_if(C("label").isNull() | ~C("label").isin(0.0, 1.0)),
    ).first()
    low0, high0, low1, high1, others = found[-5:]
    weights = None if others or low0 != high0 or low1 != high1 else tuple(1.0 if w is None else w for w in (low0, low1))
    some = [i for k, i in enumerate(numbers) if found[2 * k + 1] <= 2 * BINS]
    sets = dict(zip(some, values.agg(*[F.collect_set(C("v")[i]) for i in some]).first())) if some else {}
    for k, i in enumerate(numbers):
        known = np.unique(sets.get(i, []))
        few = i in sets and len(known) <= BINS
        cuts[i] = (known[1:] + known[:-1]) / 2 if few else np.unique(found[2 * k] or [])
    return cuts, weights


def packed(rows: DataFrame, value: str, cuts: list[np.ndarray]) -> DataFrame:
    """Blocks of binned rows: at, n, bins and the values of a long column."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            numbers = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            bins = np.stack([np.searchsorted(c, numbers[:, i]) for i, c in enumerate(cuts)], axis=1).astype(np.uint8)
            value = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column(0)[0].as_py()]), pa.array([batch.num_rows]), pa.array([bins.tobytes()], pa.binary()),
                 pa.array([value.tobytes()], pa.binary())], ["at", "n", "bins", "value"])

    prepare(rows.sparkSession)
    numbered = rows.select(F.monotonically_increasing_id().alias("at"), C(value).cast("long"), vector_to_array("features").alias("v"))
    return numbered.mapInArrow(pack, "at long, n long, bins binary, value binary")


def every(slots: int):
    return F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))


@dataclass
class GrownForest:
    """A forest whose trees lie in the shared folder, one row each."""

    path: str
    cuts: list[np.ndarray]
    featureImportances: DenseVector
    trees: int
    bytes: int

    def score(self, rows: DataFrame, name: str) -> DataFrame:
        """``rows`` with the mean vote of all trees instead of their vector. A task takes some trees and some rows."""
        spark, wide, trees = rows.sparkSession, len(self.cuts), self.trees
        numbered = rows.withColumn("__row", F.monotonically_increasing_id())
        stored = materialize(numbered, scratch_path(spark, "forest-rows"))
        size = stored.count() * (wide + 8)
        tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
        groups = max(-(-self.bytes // GROUP_BYTES), round(tasks / max(1.0, (tasks * size / self.bytes) ** 0.5)))
        groups = max(1, min(groups, trees))
        slots = max(1, -(-tasks // groups)) if size > GROUP_BYTES else 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grown, ended = [], False
            for batch in batches:
                for k in range(batch.num_rows):
                    codes, votes, n, bins, value = (batch.column(c)[k].as_py() for c in range(5))
                    if codes is not None:
                        if ended:
                            grown, ended = [], False
                        grown.append((np.frombuffer(codes, np.int64), np.frombuffer(votes, np.float64)))
                        continue
                    ended = True
                    binned = np.frombuffer(bins, np.uint8).reshape(n, wide)
                    total = np.zeros(n)
                    for tree in grown:
                        total += vote(binned, *tree)
                    yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(value, np.int64)), pa.array(total)], ["__row", "__for"])

        own = spark.read.parquet(self.path).select(
            F.lit(0).alias("part"), (C("tree") % groups).alias("group"), every(slots).alias("slot"), C("tree").cast("long").alias("at"), "codes", "votes")
        blocks = packed(stored.select("__row", "features"), "__row", self.cuts).select(
            F.lit(1).alias("part"), every(groups).alias("group"), F.pmod(F.xxhash64("at"), F.lit(slots)).cast("int").alias("slot"),
            "at", "n", "bins", "value")
        met = own.unionByName(blocks, allowMissingColumns=True)
        met = met.repartitionById(groups * slots, (C("group") * slots + C("slot")).cast("int"))
        met = met.sortWithinPartitions("group", "slot", "part", "at").select("codes", "votes", "n", "bins", "value")
        cast = met.mapInArrow(run, "__row long, __for double")
        mean = materialize(cast.groupBy("__row").agg((F.sum("__for") / trees).alias(name)), scratch_path(spark, "forest-votes"))
        return stored.drop("features").join(mean, "__row").drop("__row")


def grow(forest: RandomForestClassifier, vectors: DataFrame) -> GrownForest | None:
    """All trees in one job, each one by one task; None if the labels are not two classes or weights differ within one."""
    spark = vectors.sparkSession
    cuts, weights = looked_at(vectors)
    if weights is None:
        return None
    bins, wide = np.array([len(c) + 1 for c in cuts]), len(cuts)
    trees, seed, draw = forest.getNumTrees(), forest.getSeed(), int(np.ceil(np.sqrt(wide)))
    depth, leaf = forest.getMaxDepth(), forest.getMinInstancesPerNode()
    slots = min(trees, TASKS_PER_CORE * spark.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = {}
        for batch in batches:
            for k in range(batch.num_rows):
                slot, n, part, value = (batch.column(c)[k].as_py() for c in range(4))
                blocks.setdefault(slot, []).append((np.frombuffer(part, np.uint8).reshape(n, wide), np.frombuffer(value, np.int64)))
        for slot in list(blocks):
            own = blocks.pop(slot)
            binned, labels = np.concatenate([b for b, _ in own]), np.concatenate([v for _, v in own])
            del own
            for t in range(slot, trees, slots):
                codes, votes, shares = grow_tree(binned, labels, bins, weights, depth, leaf, draw, np.random.default_rng([seed, t]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([t], pa.int32()), pa.array([len(codes)], pa.int32()), pa.array([codes.tobytes()], pa.binary()),
                     pa.array([votes.tobytes()], pa.binary()), pa.array([shares.tolist()], pa.list_(pa.float64()))],
                    ["tree", "nodes", "codes", "votes", "shares"])

    dealt = packed(vectors, "label", cuts).withColumn("slot", every(slots)).repartitionById(slots, "slot")
    dealt = dealt.sortWithinPartitions("slot", "at").select("slot", "n", "bins", "value")
    path = scratch_path(spark, "forest")
    grown = materialize(dealt.mapInArrow(run, TREE), path).select("tree", "nodes", "shares").collect()
    if sorted(t["tree"] for t in grown) != list(range(trees)):
        raise RuntimeError(f"{len(grown)} rows for {trees} trees")
    shares = np.sum([t["shares"] for t in grown], axis=0)
    return GrownForest(path, cuts, Vectors.dense(shares / (shares.sum() or 1.0)), trees, 16 * sum(t["nodes"] for t in grown))
