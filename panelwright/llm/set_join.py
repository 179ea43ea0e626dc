"""N-gram Jaccard self-join by universe partition, with exact verification and connected components.

Shingles are 64-bit hashes. The hash universe is cut into segments; two sets close enough in size and content must agree
on a whole segment (pigeonhole), so equal segment subsets give all candidate pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import bounded, python_batches, saved, worker_state

HOT_GROUP = 2000         # sets with one least shingle beyond which their keys are aggregated before they meet others
STAR_ROUNDS = 2          # rounds with one partner per key before the pairs that may be left are listed
# Sets of one key up to which all their pairs are tested: two, which the star has done. A larger bound is crossed by a growing
# table's keys, so that the sets left to rare_pairs would grow faster than the table.
SMALL_KEY = 2
SHINGLE_PARTS = 2        # parts of all shingles that are counted one after the other: rows of one part at a time are on disk
CHUNK = 1 << 18          # bytes hashed at once

_U = np.uint64
_rng = np.random.default_rng(2025)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE[65:91] = _BYTE[97:123]                                  # only A-Z are lower-cased
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_STEP = int(_rng.integers(1, 1 << 62)) * 4 + 3                # odd, so invertible modulo 2**64
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done:done + step] = out[:step] * _U(pow(base, done, 1 << 64))
        done += step
    return out


class WordHasher:
    """Hashes of all words of joined texts: polynomial prefix sums modulo 2**64, then a finalizer."""

    def __init__(self):
        self.up, self.down = _powers(_STEP, CHUNK + 1), _powers(pow(_STEP, -1, 1 << 64), CHUNK + 1)

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(data, np.uint8)
        starts, hashes, at = [], [], 0
        while at < len(raw):
            end = min(at + CHUNK, len(raw))
            if end < len(raw):
                gaps = np.flatnonzero(_SPACE[raw[at:end]])
                if len(gaps):
                    end = at + int(gaps[-1]) + 1
                else:                                        # one word longer than a chunk
                    while end < len(raw) and not _SPACE[raw[end]]:
                        end += 1
            part = raw[at:end]
            if len(part) > len(self.up):
                self.up, self.down = _powers(_STEP, len(part) + 1), _powers(pow(_STEP, -1, 1 << 64), len(part) + 1)
            inside = np.concatenate([[False], ~_SPACE[part], [False]])
            edge = np.flatnonzero(inside[1:] != inside[:-1])
            first, last = edge[::2], edge[1::2]
            sums = np.concatenate([[_U(0)], np.cumsum(_BYTE[part] * self.up[:len(part)], dtype=np.uint64)])
            hashes.append(mixed((sums[last] - sums[first]) * self.down[first] + (last - first).astype(np.uint64)))
            starts.append(first + at)
            at = end
        if not starts:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return np.concatenate(starts), np.concatenate(hashes)


def shingle_sets(texts: pa.Array, size: int, hasher: WordHasher) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle, without words none."""
    raw = [t or b"" for t in texts.cast(pa.binary()).to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in raw])])
    starts, words = hasher(b" ".join(raw))
    cuts = np.searchsorted(starts, bounds)
    n = len(words) - size + 1
    whole = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        whole += words[k:k + n] * _PLACE[k]
    whole = mixed(whole)
    for a, b in zip(cuts, cuts[1:]):
        if b - a >= size:
            yield np.unique(whole[a:b - size + 1])
        elif b > a:
            yield mixed(np.array([(words[a:b] * _PLACE[:b - a]).sum(dtype=np.uint64) + _U(b - a)]))
        else:
            yield np.zeros(0, np.uint64)


@dataclass(frozen=True)
class Threshold:
    """Jaccard of at least ``percent`` / 100, in integers."""

    percent: int

    def bands(self, largest: int) -> np.ndarray:
        """Last size of each band; sets that can be linked are in one band or in neighbours."""
        out, low = [], 1
        while not out or out[-1] < largest:
            out.append(low * 100 // self.percent)
            low = out[-1] + 1
        return np.array(out)

    def most_apart(self, last: int) -> int:
        """Elements that two linked sets of up to ``last`` elements can differ in."""
        return (100 - self.percent) * 2 * last // (100 + self.percent)


def segment_keys(shingles: np.ndarray, band: int, apart: int) -> np.ndarray:
    """Index keys of one set in one band.

    ``apart + 1`` segments: a linked set agrees on one of them at least. A segment's key costs the sets that share
    it. An empty subset is the dear one, shared by all sets with a gap there, so it gets no key and its share goes to
    the next segment, as one-deletion neighbourhoods: if two sets agree on empty segments only, the differences left
    over the other segments are so few that one segment behind an empty one differs by one element or none.
    """
    m = apart + 1
    place = (shingles >> _U(32)) * _U(m) >> _U(32)
    order = np.argsort(place, kind="stable")
    place, value = place[order].astype(np.int64), mixed(shingles[order] + _U(0x9E3779B97F4A7C15))
    used, first, count = np.unique(place, return_index=True, return_counts=True)
    sums = np.add.reduceat(value, first)
    tag = _U((band * 2 + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    keys = [mixed(sums + mixed(used.astype(np.uint64) + tag) + count.astype(np.uint64))]
    if len(used) < m:
        near = _U((band * 2 + 2) * 0xD1B54A32D192ED03 % (1 << 64))
        empty = np.setdiff1d(np.arange(m), used, assume_unique=True)
        for j in np.unique((empty + 1) % m):
            at = np.searchsorted(used, j)
            full = at < len(used) and used[at] == j
            total = sums[at] if full else _U(0)
            own = value[first[at]:first[at] + count[at]] if full else value[:0]
            subsets = np.concatenate([[total], total - own])
            sizes = np.concatenate([[len(own)], np.full(len(own), len(own) - 1)]).astype(np.uint64)
            keys.append(mixed(subsets + mixed(np.array([_U(int(j)) + near])) + sizes))
    return np.concatenate(keys)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def parity(shingles: np.ndarray) -> bytes:
    """A bitmap of two to four bits a shingle: whether an even or odd number of shingles fall on a bit.

    Two sets differ in as many shingles at least as their bitmaps do in bits.
    """
    bits = 64
    while bits < 2 * len(shingles):
        bits *= 2
    return np.packbits((np.bincount((shingles & _U(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(bool)).tobytes()


def bits_apart(a: bytes, b: bytes) -> int:
    """Bits in which two bitmaps differ; a larger one is folded to the size of the other."""
    x, y = sorted((np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)), key=len)
    return int(np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum())


def signatures(docs: DataFrame, shingle: int, text: bool = False) -> DataFrame:
    """doc_id, n_shingles, a 128-bit hash of the set (``s1``, ``s2``), its least shingle and its ``parity``, of every row;
    with its ``text`` if asked for."""
    python_batches(docs.sparkSession, 1000, "2m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("set_join")
        hasher = WordHasher()
        for batch in batches:
            rows = [(len(s), mixed(s + _U(1)).sum(dtype=np.uint64), mixed(s ^ _U(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64),
                     s[0] if len(s) else _U(0), parity(s)) for s in shingle_sets(batch.column(1), shingle, hasher)]
            cols = [_signed(np.array([r[k] for r in rows], np.uint64)) for k in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *cols, pa.array([r[4] for r in rows], pa.binary()), *batch.columns[1:1 + text]],
                ["doc_id", "n_shingles", "s1", "s2", "least", "parity", *["text"] * text])

    schema = "doc_id long, n_shingles long, s1 long, s2 long, least long, parity binary" + ", text string" * text
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def index_keys(nodes: DataFrame, shingle: int, threshold: Threshold) -> DataFrame:
    """(key, id) rows of representative sets; ``nodes`` has id and text."""
    python_batches(nodes.sparkSession, 1000, "2m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("set_join")
        hasher, lasts = WordHasher(), threshold.bands(1 << 16)
        for batch in batches:
            keys, counts = [], []
            for s in shingle_sets(batch.column(1), shingle, hasher):
                if len(s) > lasts[-1]:
                    lasts = threshold.bands(len(s) * 2)
                before = len(keys)
                if len(s):
                    band = int(np.searchsorted(lasts, len(s)))
                    for b in (band, band + 1):
                        last = int(lasts[b]) if b < len(lasts) else int(threshold.bands(int(lasts[-1]) + 1)[b])
                        apart = threshold.most_apart(last)
                        if apart:                            # else only equal sets are linked, and those are one node
                            keys.append(segment_keys(s, b, apart))
                counts.append(sum(map(len, keys[before:])))
            flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
            take = pa.array(np.repeat(np.arange(batch.num_rows), counts))
            yield pa.RecordBatch.from_arrays([_signed(flat), batch.column(0).take(take)], ["key", "id"])

    return nodes.select("id", "text").mapInArrow(run, "key long, id long")


def stored_sets(nodes: DataFrame, shingle: int, part: int = 0, parts: int = 1) -> DataFrame:
    """id, size of its set and its sorted shingles, or of these one of several parts that all sets are cut into alike."""
    python_batches(nodes.sparkSession, 500, "2m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("set_join")
        hasher = WordHasher()
        for batch in batches:
            sets = list(shingle_sets(batch.column(1), shingle, hasher))
            sizes = pa.array([len(s) for s in sets], pa.int32())
            if parts > 1:
                sets = [s[s % _U(parts) == part] for s in sets]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), sizes, pa.ListArray.from_arrays(pa.array(offsets), _signed(flat))], ["id", "n", "shingles"])

    return nodes.select("id", "text").mapInArrow(run, "id long, n int, shingles array<long>")


def shared_keys(cold: DataFrame, hot: DataFrame) -> DataFrame:
    """(key, id) of keys that two or more sets have, of the keys of ``hot`` groups' sets and of all others.

    Sets of a hot group are aggregated by key first and meet the others as one row, so that no key gathers a group in
    one task; their own rows come back by a join whose skewed partitions Spark splits. ``hot`` is made twice.
    """
    heads = saved(hot.groupBy("key").agg(F.min("id").alias("id"), F.max("id").alias("other")), "hot_keys")
    met = cold.select("key", "id", F.lit(False).alias("head"), F.lit(False).alias("many")).unionByName(
        heads.select("key", "id", F.lit(True).alias("head"), (F.col("id") != F.col("other")).alias("many")))
    alike = F.count("*").over(Window.partitionBy("key"))
    met = saved(met.withColumn("n", alike).where((F.col("n") > 1) | F.col("many")).drop("n", "many"), "met_keys")
    wanted = met.where("head").select(F.col("key"))
    back = hot.join(bounded(wanted), "key").select("key", "id")
    return met.where(~F.col("head")).select("key", "id").unionByName(back)


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) with the least id reachable over (a, b) edges, for every id on an edge; ids are of any ordered type.

    Each round sends an id to its least neighbour, follows those pointers to their ends and contracts the graph; rounds
    are logarithmic, every table is written, nothing of it comes to the driver but whether it is empty.
    """
    edges = saved(edges.select("a", "b").where("a != b").distinct(), "edges")
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        point = saved(both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("id"), F.least("a", "m").alias("comp")), "pointers")
        while True:
            up = point.select(F.col("id").alias("comp"), F.col("comp").alias("next"))
            jumped = saved(point.join(up, "comp", "left").select(
                "id", F.coalesce("next", "comp").alias("comp"), (F.col("next") != F.col("comp")).alias("moved")), "jumps")
            point = jumped.select("id", "comp")
            if jumped.where("moved").isEmpty():
                break
        step = point.select(F.col("id").alias("comp"), F.col("comp").alias("next"))
        labels = point if labels is None else saved(labels.join(step, "comp", "left").select(
            "id", F.coalesce("next", "comp").alias("comp")), "labels")
        a = point.select(F.col("id").alias("a"), F.col("comp").alias("ca"))
        b = point.select(F.col("id").alias("b"), F.col("comp").alias("cb"))
        edges = saved(edges.join(a, "a").join(b, "b").where("ca != cb").select(
            F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "edges")
        if edges.isEmpty():
            return labels


def near(pairs: DataFrame, sketches: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs that sizes and bitmaps leave: those of linked sets are among them."""
    p = threshold.percent
    sides = [sketches.select(F.col("id").alias(f"i{s}"), F.col("n").alias(f"n{s}"), F.col("parity").alias(f"p{s}")) for s in "ab"]
    met = pairs.join(sides[0], F.col("a.i") == F.col("ia")).join(sides[1], F.col("b.i") == F.col("ib"))
    met = met.where(100 * F.least("na", "nb") >= p * F.greatest("na", "nb")).select("a", "b", "na", "nb", "pa", "pb")
    python_batches(pairs.sparkSession, 4000, "4m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("set_join")
        for batch in batches:
            size = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            apart = np.fromiter(map(bits_apart, batch.column(4).to_pylist(), batch.column(5).to_pylist()), np.int64, batch.num_rows)
            yield batch.select([0, 1]).filter(pa.array(apart * (100 + p) <= size * (100 - p)))

    return met.mapInArrow(run, met.select("a", "b").schema)


def verified(pairs: DataFrame, sets: Callable[[DataFrame], DataFrame], threshold: Threshold) -> DataFrame:
    """The pairs whose sets are linked, from their full sets; ``sets`` makes those of the ids asked for."""
    p = threshold.percent
    if pairs.isEmpty():
        return pairs
    ids = pairs.select(F.col("a.i").alias("id")).unionByName(pairs.select(F.col("b.i").alias("id"))).distinct()
    full = saved(sets(bounded(saved(ids, "asked"))).select("id", "shingles"), "sets")
    a = full.select(F.col("id").alias("ia"), F.col("shingles").alias("sa"))
    b = full.select(F.col("id").alias("ib"), F.col("shingles").alias("sb"))
    met = pairs.join(a, F.col("a.i") == F.col("ia")).join(b, F.col("b.i") == F.col("ib"))
    both = F.size(F.array_intersect("sa", "sb"))
    return met.where(100 * both >= p * (F.size("sa") + F.size("sb") - both)).select("a", "b").distinct()


def rare_pairs(nodes: DataFrame, sets: Callable[..., DataFrame], threshold: Threshold) -> DataFrame:
    """Pairs (a, b) of nodes in different components that can be linked, by their rarest shingles.

    Shingles stand in one order, rare ones first. The first that two linked sets share must leave both enough
    shingles behind it, so it is among the first few of either. Members of a group of near copies that are not linked
    differ in shingles of their own, and those come first: unlike pairs of a segment key they do not meet. A shingle's
    largest component is only paired with the rest, never with itself. Shingles are counted part by part, each from texts
    hashed anew: most have one set only and are not kept.
    """
    p = threshold.percent
    asked = bounded(saved(nodes.select(F.col("node.i").alias("id")).distinct(), "asked"))
    often = None
    for part in range(SHINGLE_PARTS):
        tokens = sets(asked, part, SHINGLE_PARTS).select("id", "n", F.explode("shingles").alias("token"))
        tokens = tokens.withColumn("df", F.count("*").over(Window.partitionBy("token"))).where("df > 1")
        tokens = saved(tokens, "repeated_shingles")
        often = tokens if often is None else often.unionByName(tokens)
    # Shingles that no other set has come first of all; only the others are numbered.
    place = F.row_number().over(Window.partitionBy("id").orderBy("df", "token")) - 1
    alone = F.col("n") - F.count("*").over(Window.partitionBy("id"))
    rows = often.withColumn("pos", place + alone).where(F.col("pos") * 100 <= F.col("n") * (100 - p))
    rows = rows.select("id", "n", "token", "pos").join(nodes, F.col("id") == F.col("node.i")).drop("id")
    rows = saved(rows, "rare_shingles")
    comps = rows.groupBy("token", "comp").agg(F.count("*").alias("k"))
    main = comps.groupBy("token").agg(F.max_by("comp", F.struct("k", "comp")).alias("main"), F.count("*").alias("comps"))
    open_tokens = saved(main.where("comps > 1").select("token", "main"), "open_tokens")
    placed = rows.join(open_tokens, "token")
    one = placed.where("comp != main").select("token", *[F.col(c).alias(f"x_{c}") for c in ("node", "comp", "n", "pos")])
    two = placed.select("token", *[F.col(c).alias(f"y_{c}") for c in ("node", "comp", "n", "pos")])
    both = F.floor((p * (F.col("x_n") + F.col("y_n")) + 99 + p) / (100 + p))     # shingles that linked sets share
    met = one.join(two, "token").where("x_comp != y_comp").where(
        (F.col("x_pos") <= F.col("x_n") - both) & (F.col("y_pos") <= F.col("y_n") - both))
    return met.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def linked(
    shared: DataFrame, known: DataFrame, sketches: DataFrame, sets: Callable[..., DataFrame], threshold: Threshold,
) -> DataFrame:
    """(id, comp) of sets that share keys or have a ``known`` edge (a, b); ``shared`` is a saved table of (key, id), comp the
    least id.

    All pairs of a key are candidates, but a link inside a component tells nothing new. First, for every key, its
    members are tested against one of them: the set with most shared keys, the centre of a group of near copies. Then,
    of keys that still hold more than one component, the small ones have all pairs of components tested, the others test
    their members against another one. A link still missing joins two components over a large key that both are left in;
    of the pairs of such sets, ``rare_pairs`` lists those that can be links, and all of them are tested. Nodes are
    ordered by shared keys and id, so that components contract to the centres at once.
    """
    ids = known.select(F.col("a").alias("id")).unionByName(known.select(F.col("b").alias("id")))
    degree = shared.select("id", F.lit(1).alias("k")).unionByName(ids.select("id", F.lit(0).alias("k"))).groupBy("id").agg(
        F.sum("k").alias("degree"))
    node = F.struct((-F.col("degree")).alias("d"), F.col("id").alias("i")).alias("node")
    comp = saved(degree.select(node, node.alias("comp")), "nodes")
    of = lambda side: comp.select(F.col("node.i").alias(side), F.col("node").alias(f"{side}_node"))
    edges = known.join(of("a"), "a").join(of("b"), "b").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    comp = joined(comp, saved(edges, "known"))
    size = Window.partitionBy("key")
    shared = saved(shared.join(degree, "id").select("key", node).withColumn(
        "small", F.count("*").over(size) <= SMALL_KEY), "members")
    tested = None
    for turn in range(STAR_ROUNDS + 1):
        placed = shared.join(comp, "node")
        rank = F.struct(F.xxhash64("node.i", F.lit(turn)).alias("h") if turn else F.lit(0).alias("h"), F.col("node"), F.col("comp"))
        split = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.min(rank).alias("hub"))
        split = split.where("low < high").select("key", F.col("hub.node").alias("hub"), F.col("hub.comp").alias("hub_comp"))
        placed = saved(placed.join(split, "key"), "open_members")
        if placed.isEmpty():
            break
        star = placed.where("comp != hub_comp").select(
            F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"), "small")
        if turn < STAR_ROUNDS - 1:
            shared, pairs = placed.select("key", "node", "small"), star.drop("small")
        elif turn == STAR_ROUNDS - 1:
            few = placed.where("small")
            other = few.select("key", F.col("node").alias("b"), F.col("comp").alias("b_comp"))
            every = few.select("key", F.col("node").alias("a"), "comp").join(other, "key").where("a < b and comp != b_comp")
            pairs = star.where("not small").drop("small").unionByName(every.select("a", "b"))
            shared = placed.where("not small").select("key", "node", "small")
        else:
            pairs = rare_pairs(placed.select("node", "comp").distinct(), sets, threshold)
        pairs = pairs.distinct()
        pairs = saved(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        comp = joined(comp, saved(verified(saved(near(pairs, sketches, threshold), "near"), sets, threshold), "links"))
    least = comp.groupBy("comp").agg(F.min("node.i").alias("least"))
    return comp.join(least, "comp").select(F.col("node.i").alias("id"), F.col("least").alias("comp"))


def joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """(node, comp) after further links (a, b) of nodes."""
    if links.isEmpty():
        return comp
    known = comp.select(F.col("node").alias("a"), F.col("comp").alias("b"))
    labels = components(known.unionByName(links)).select(F.col("id").alias("node"), F.col("comp").alias("new"))
    return saved(comp.join(labels, "node", "left").select("node", F.coalesce("new", "node").alias("comp")), "comp")


def near_duplicates(docs: DataFrame, *, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Component of every document under shingle-set Jaccard of ``percent`` / 100 or more.

    Returns one row per input row: doc_id, n_shingles, component_id (smallest doc_id reachable by links, itself
    included). Equal sets are one node, so copies are never paired with each other. Null or wordless texts are linked
    with nothing; rows that share an id are one document; rows with null id stay alone with a null component; an empty
    table gives an empty result; other columns are ignored. Sets are compared as 64-bit hashes: a wrong link needs
    collisions inside two documents, not in the table.
    """
    threshold = Threshold(percent)
    kind = ["s1", "s2", "n_shingles"]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marks = saved(signatures(docs, shingle), "signatures")
    sets = marks.where("n_shingles > 0 and doc_id is not null")
    kinds = sets.groupBy(*kind).agg(F.min("doc_id").alias("first"), F.min("least").alias("least"), F.min("parity").alias("parity"),
                                    F.count("*").alias("copies"))
    # A set is named by the least id that has it; of several sets with the same one, all but one by a hash.
    turn = F.row_number().over(Window.partitionBy("first").orderBy(*kind))
    kinds = saved(kinds.withColumn("id", F.when(turn == 1, F.col("first")).otherwise(F.xxhash64("first", *kind))), "kinds")
    crowded = kinds.groupBy("least").count().where(F.col("count") > HOT_GROUP).select("least")
    # Ids with several sets, and the sets of each as edges.
    several = sets.select("doc_id", *kind).distinct().withColumn("sets", F.count("*").over(Window.partitionBy("doc_id")))
    several = saved(several.where("sets > 1").join(kinds.select("id", *kind), kind).select("doc_id", "id"), "several")
    known = several.join(several.groupBy("doc_id").agg(F.min("id").alias("b")), "doc_id").where("id != b").select(
        F.col("id").alias("a"), "b")
    several = bounded(saved(several.select("doc_id").distinct(), "repeated_ids"))
    copies = sets.join(bounded(saved(kinds.where("copies > 1").select(*kind, "first"), "copied")), kind).where("doc_id != first")
    copies = saved(copies.select("doc_id").distinct(), "copies")
    hot = kinds.join(bounded(saved(crowded, "crowded")), "least", "left_semi").select("id")
    hot = bounded(saved(hot, "hot"))
    # A document whose set another one has first is left out: its links are those of the other.
    docs = docs.where("doc_id is not null")
    once = docs.join(several, "doc_id", "left_anti").join(bounded(copies), "doc_id", "left_anti").withColumnRenamed("doc_id", "id")
    more = signatures(docs.join(several, "doc_id", "left_semi"), shingle, text=True).join(kinds.select("id", "first", *kind), kind)
    nodes = once.unionByName(more.where(F.col("doc_id") == F.col("first")).select("id", "text").dropDuplicates(["id"]))
    # Hot and other sets part before their texts are hashed: nothing is hashed only to be dropped.
    shared = saved(shared_keys(*(index_keys(nodes.join(hot, "id", how), shingle, threshold) for how in ("left_anti", "left_semi"))), "shared")
    met = bounded(saved(shared.select("id").distinct(), "candidates"))
    sketches = saved(kinds.join(met, "id", "left_semi").select("id", F.col("n_shingles").alias("n"), "parity"), "sketches")
    comp = linked(shared, saved(known, "same_id"), sketches,
                  lambda ids, *part: stored_sets(nodes.join(ids, "id", "left_semi"), shingle, *part), threshold)
    comp = saved(comp, "components")
    # The least id of a component is that of its sets' first documents.
    comp = kinds.join(comp, "id", "left").select(*kind, "first", F.coalesce("comp", "id").alias("comp"))
    least = comp.groupBy("comp").agg(F.min("first").alias("component"))
    of_kind = saved(comp.join(least, "comp").select(*kind, "component"), "component_of_set")
    return marks.join(of_kind, kind, "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component"))).otherwise(F.col("doc_id"))
        .alias("component_id"))


def representatives(docs: DataFrame, **options) -> DataFrame:
    """One document of each component, the one with its smallest id, with all its columns."""
    found = near_duplicates(docs, **options)
    gone = bounded(saved(found.where("doc_id != component_id").select("doc_id").distinct(), "near_copies"))
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
