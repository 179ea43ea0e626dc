"""Hard negatives by BOND: a branch-and-bound scan over vertically stored dimensions.

Vectors are integers. A block holds some thousand rows, one array per dimension. A group of anchors reads the dimensions
of a block in the order of its own magnitudes, the largest first, as one matrix product for many dimensions and anchors.
What the dimensions still to come can add lies between sums of the block's minima and maxima, so that pairs leave the
candidate bitmap as soon as their bounds cannot reach a wanted window of scores; the few pairs left are read on one by
one, and for those left after the last dimension the score is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.common import python_batches, saved

BLOCK_ROWS = 4096        # rows of a block
ANCHORS_AT_ONCE = 65536  # anchors, about, that meet a block together
ANCHOR_VALUES = 1 << 24  # components of their vectors at most
PIECE = 1024             # anchors, about, in one row on their way
GROUP = 256              # anchors of one matrix product
STEP = 8                 # dimensions read between two looks at the bounds of single pairs
FEW = 0.01               # share of live pairs from which on they are read one by one
FIRST_PAIRS = 1 << 16    # pairs of the first product of a search; later ones take as many rows as were seen before
MANY = 8                 # in its first rows an anchor with more than so many times k live pairs looks for a bound
EXACT = 1 << 53          # doubles hold integers up to here
EXACT_FLOAT = 1 << 24    # and floats up to here
CHUNKS = 4               # chunks of anchors at least, if they fill a group: blocks are sent as often
TASKS_PER_CORE = 2       # a task finds bounds of its own, so more slots of blocks cost more than more chunks

TILE = "block long, uids binary, ids binary, labels binary, columns binary, width int"


def usable(vectors: DataFrame, id_col: str, vector_col: str, label: Column, anchor: Column) -> DataFrame:
    """uid, vec_id, label, vec, anchor of the rows that take part; ``uid`` tells rows apart, also such with equal ids."""
    floats = vectors.schema[vector_col].dataType.jsonValue()["elementType"] == "float"       # doubles hold them all
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.col(vector_col).cast("array<float>" if floats else "array<double>").alias("vec"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull())
    inf = float("inf")                                                                       # NaN sorts above it
    finite = (F.size("vec") == 0) | ((F.array_min("vec") > -inf) & (F.array_max("vec") < inf))
    rows = rows.where(finite & F.forall("vec", lambda x: x.isNotNull()))
    return saved(rows.withColumn("uid", F.monotonically_increasing_id()), "vectors")


def matrix(vectors: pa.Array, dims: int, scale: int) -> np.ndarray:
    """One row of integers for each vector: ``floor(scale * x)``, zeros behind a short one."""
    flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if dims and len(flat) and float(np.abs(flat).max()) ** 2 * dims >= EXACT:
        raise ValueError("inner products of these components pass 2**53")
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), dims), np.int32)
    first = np.cumsum(sizes) - sizes
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - first[row]] = flat
    return out


def blocks(rows: DataFrame, dims: int, scale: int) -> DataFrame:
    """Rows packed into blocks where they lie: ids, labels and one array per dimension, sorted by label."""
    python_batches(rows.sparkSession, BLOCK_ROWS, "64m")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                uids, ids, labels = (part.column(k).to_numpy() for k in range(3))
                order = np.argsort(labels, kind="stable")
                columns = np.ascontiguousarray(matrix(part.column(3), dims, scale)[order].T)
                if columns.size and np.abs(columns).max() < 1 << 15:
                    columns = columns.astype(np.int16)
                cells = [uids[order].tobytes(), ids[order].tobytes(), labels[order].tobytes(), columns.tobytes()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(uids.min())]), *(pa.array([c], pa.binary()) for c in cells),
                     pa.array([columns.itemsize], pa.int32())],
                    ["block", "uids", "ids", "labels", "columns", "width"])

    return rows.select("uid", "vec_id", "label", "vec").mapInArrow(pack, TILE)


def chunked(anchors: DataFrame, chunks: int, pieces: int) -> DataFrame:
    """Anchors packed into ``chunks`` groups of about equal size by a hash of their uid, each one in ``pieces`` rows."""
    part = F.pmod(F.xxhash64("uid"), F.lit(chunks * pieces))
    members = F.collect_list(F.struct("uid", "label", "vec", "positives"))
    packed = anchors.groupBy(part.alias("block")).agg(members.alias("anchors"))
    return packed.withColumn("chunk", F.pmod(F.col("block"), F.lit(chunks)).cast("int"))


def tiles(packed: DataFrame, anchors: DataFrame, chunks: int, pieces: int) -> DataFrame:
    """Every chunk of anchors beside every block: one task a (chunk, slot), which gets the chunk's anchors before the
    slot's blocks."""
    tasks = TASKS_PER_CORE * packed.sparkSession.sparkContext.defaultParallelism
    slots = max(1, -(-tasks // chunks))
    left = packed.withColumns({"slot": F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int"), "part": F.lit(1)}).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    right = chunked(anchors, chunks, pieces).withColumns({"part": F.lit(0), "slot": F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))})
    both = left.unionByName(right, allowMissingColumns=True)
    dealt = both.repartitionById(chunks * slots, (F.col("chunk") * slots + F.col("slot")).cast("int"))
    return dealt.sortWithinPartitions("chunk", "slot", "part", "block").select(
        "chunk", "slot", "anchors", "uids", "ids", "labels", "columns", "width")


class Block:
    """A block's columns with their minima and maxima."""

    def __init__(self, uids: bytes, ids: bytes, labels: bytes, columns: bytes, width: int = 4):
        self.uids, self.ids, self.labels = (np.frombuffer(x, np.int64) for x in (uids, ids, labels))
        whole = np.frombuffer(columns, f"i{width}").reshape(-1, len(self.ids))
        self.columns = whole.astype(np.float32)
        # Partial sums of two vectors stay within the product of their lengths.
        self.length = float(np.sqrt(np.einsum("ij,ij->j", self.columns, self.columns, dtype=np.float64).max(initial=0))) * 1.001
        if not np.array_equal(self.columns, whole):
            self.columns = whole.astype(np.float64)
        self.least, self.most = self.columns.min(axis=1), self.columns.max(axis=1)

    def exact(self, length: float) -> np.ndarray:
        """The columns in a type that holds every score with vectors of this length."""
        if self.columns.dtype == np.float32 and self.length * length >= EXACT_FLOAT:
            self.columns = self.columns.astype(np.float64)
        return self.columns

    def to_come(self, query: Queries) -> tuple[np.ndarray, np.ndarray]:
        """The least and the most that the dimensions from each place of the order on can add, for each anchor."""
        anchors, dims = query.values.shape
        low, high = np.zeros((2, dims + 1, anchors))
        if query.reach < dims:
            ends = np.stack([query.values * self.least, query.values * self.most])[:, :, query.order[::-1]]
            low[-2::-1], high[-2::-1] = np.cumsum(ends.min(axis=0).T, axis=0), np.cumsum(ends.max(axis=0).T, axis=0)
        return low, high

    def scan(self, query: Queries, span: slice, wanted: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, anchors and scores of the pairs that stay, of the rows in ``span``. ``wanted`` maps scores so far, and
        the least and the most that is still to come for each anchor, to a bitmap: of all rows and anchors, or of a list
        of pairs, whose anchors it then gets."""
        columns = self.exact(query.length)[:, span]
        values = query.values if columns.dtype == np.float64 else query.narrow
        order, dims = query.order, len(query.order)
        low, high = self.to_come(query)
        begin, end = 0, query.reach
        while True:
            read = order[begin:end] if end - begin < dims else slice(None)
            if begin == 0:
                score = np.matmul(values[:, read], columns[read], out=query.room(columns.dtype, columns.shape[1])).T
            else:
                score += (values[:, read] @ columns[read]).T
            live = wanted(score, (low[end], high[end]), None)
            few = np.count_nonzero(live) <= FEW * live.size
            if begin == 0 and not few:
                query.reach = min(dims, end + STEP)         # the first look comes later in the next blocks
            if few or end >= dims:
                break
            begin, end = end, min(dims, end + max(STEP, (dims - end) // 2))
        at, who = pairs(live)
        score = score[at, who].astype(np.float64)
        while end < dims:
            read, end = order[end:end + STEP], min(dims, end + STEP)
            score += np.einsum("dp,dp->p", columns[np.ix_(read, at)], values[np.ix_(who, read)].T, dtype=np.float64)
            stay = wanted(score, (low[end][who], high[end][who]), who)
            at, who, score = at[stay], who[stay], score[stay]
        return at + (span.start or 0), who, score


def pairs(live: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the set places of a bitmap, column by column; eight places are looked at together."""
    flat, long = live.reshape(-1, order="F"), max(len(live), 1)
    if flat.size % 8 == 0:
        words = np.flatnonzero(flat.view(np.uint64))
        near = (words[:, None] * 8 + np.arange(8)).reshape(-1)
        flat = near[flat[near]]
    else:
        flat = np.flatnonzero(flat)
    return flat % long, flat // long


class Queries:
    """Vectors of a group of anchors and the order in which their dimensions are read."""

    def __init__(self, values: np.ndarray):
        self.values = np.ascontiguousarray(values, np.float64)
        self.narrow = self.values.astype(np.float32)
        self.length = float(np.sqrt((self.values ** 2).sum(axis=1).max(initial=0))) * 1.001
        self.order = np.argsort(-np.abs(self.values).sum(axis=0), kind="stable")
        self.reach = max(min(STEP, len(self.order)), len(self.order) // 2)      # dimensions read before the first look


    def room(self, kind: np.dtype, rows: int) -> np.ndarray:
        """Memory for the scores of one product, used again by the next one of any group."""
        size = rows * len(self.values)
        if len(_ROOM.get(kind, ())) < size:
            _ROOM[kind] = np.empty(size, kind)
        return _ROOM[kind][:size].reshape(-1, rows)


_ROOM: dict[np.dtype, np.ndarray] = {}


def top(k: int, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the first ``k`` of each key by score, ties by id, and their ranks from 0."""
    order = np.lexsort((ids, -scores, keys))
    new = np.ones(len(order), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    begins = np.flatnonzero(new)
    rank = np.arange(len(order)) - np.repeat(begins, np.diff(np.append(begins, len(order))))
    return order[rank < k], rank[rank < k]


class Search:
    """First ``k`` rows in each window of the anchors of a group, over the blocks seen so far. An anchor's window w takes
    scores from ``low`` to ``high``; both are (windows, anchors) arrays."""

    def __init__(self, uids: np.ndarray, labels: np.ndarray, values: np.ndarray, k: int, low: np.ndarray, high: np.ndarray):
        self.uids, self.labels, self.k, self.low, self.high = uids, labels, k, low, high
        self.query = Queries(values)
        none = np.iinfo(np.int64).max
        self.scores = np.full((*low.shape, k), -np.inf)
        self.all_ids = np.full((*low.shape, k), none)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.seen = 0
        self.bounds()

    @property
    def ids(self) -> np.ndarray:
        """Ids found for all windows, best first."""
        self.settle()
        return self.all_ids[self.scores > -np.inf]

    def bounds(self) -> None:
        """What a new row has to reach in each window, and in any."""
        self.floor = np.maximum(self.low, self.scores[..., -1])
        self.least, self.most = self.floor.min(axis=0), self.high.max(axis=0)

    def settle(self) -> None:
        """Merge what waits into the results."""
        if not self.waiting:
            return
        keys, scores, ids = (np.concatenate(c) for c in zip(*self.waiting))
        self.waiting = []
        touched = np.unique(keys)
        flat_scores, flat_ids = self.scores.reshape(-1, self.k), self.all_ids.reshape(-1, self.k)
        keys = np.concatenate([np.repeat(touched, self.k), keys])
        scores = np.concatenate([flat_scores[touched].reshape(-1), scores])
        ids = np.concatenate([flat_ids[touched].reshape(-1), ids])
        first, rank = top(self.k, keys, scores, ids)
        flat_scores[keys[first], rank], flat_ids[keys[first], rank] = scores[first], ids[first]
        self.bounds()

    def apart(self, block: Block, at: np.ndarray | slice, who: np.ndarray | slice) -> np.ndarray:
        """Whether rows and anchors may meet: by pairs, or all rows of a span with all or some anchors."""
        raise NotImplementedError

    def scan(self, block: Block, span: slice, mixed: bool) -> None:
        """Take what the rows of ``span`` hold; ``mixed``: some of them may not meet some of the anchors. The first rows of
        all are taken in small parts, so that most of them start from bounds already."""
        at = span.start
        while at < span.stop:
            end = min(span.stop, at + max(FIRST_PAIRS // len(self.uids), self.seen))
            self.take(block, slice(at, end), mixed)
            self.seen += end - at
            if end < span.stop or sum(len(w[0]) for w in self.waiting) > self.low.size:
                self.settle()
            at = end

    def take(self, block: Block, span: slice, mixed: bool) -> None:
        def wanted(score, rest, who):
            low, high = rest
            if who is not None:
                return (score >= self.least[who] - high) & (score <= self.most[who] - low)
            live = score >= (self.least - high).astype(score.dtype)
            if self.seen < BLOCK_ROWS:
                crowded = np.flatnonzero(np.count_nonzero(live, axis=0) > MANY * self.k)
                live[:, crowded] = self.within(block, span, mixed, score[:, crowded], low[crowded], high[crowded], crowded)
            return live

        at, who, score = block.scan(self.query, span, wanted)
        keep = score <= self.most[who]
        if mixed:
            keep &= self.apart(block, at, who)
        at, who, score = at[keep], who[keep], score[keep]
        floor, ids = self.floor[:, who], block.ids[at]
        inside = (score > floor) | ((score == floor) & ((score > self.scores[:, who, -1]) | (ids < self.all_ids[:, who, -1])))
        window, pair = np.nonzero(inside & (score <= self.high[:, who]))
        if len(pair):
            self.waiting.append((window * self.low.shape[1] + who[pair], score[pair], ids[pair]))

    def within(self, block: Block, span: slice, mixed: bool, score, low, high, who: np.ndarray) -> np.ndarray:
        """The bitmap of anchors with many live pairs, by the k-th best of the lower bounds that are in a window for sure."""
        lower, upper = score + low, score + high
        may = self.apart(block, span, who) if mixed else None
        live = np.zeros(score.shape, bool)
        for w in range(len(self.low)):
            sure = (lower >= self.low[w, who]) & (upper <= self.high[w, who])
            if may is not None:
                sure &= may
            best = np.where(sure, lower, -np.inf).T
            best = np.partition(best, -self.k, axis=1)[:, -self.k] if best.shape[1] >= self.k else -np.inf
            live |= (upper >= np.maximum(self.floor[w, who], best)) & (lower <= self.high[w, who])
        return live if may is None else live & may

    def rows(self) -> Iterator[tuple[np.ndarray, ...]]:
        self.settle()
        window, who, rank = np.nonzero(self.scores > -np.inf)
        yield self.uids[who], window, self.scores[window, who, rank], self.all_ids[window, who, rank]

    def span(self, block: Block) -> slice:
        """The rows whose labels lie between those of the group."""
        return slice(*(int(np.searchsorted(block.labels, label, side)) for label, side in
                       ((self.labels.min(), "left"), (self.labels.max(), "right"))))


class Nearest(Search):
    """First ``k`` rows of the anchors' labels over the blocks seen so far."""

    def __init__(self, anchors: dict, dims: int, scale: int, k: int):
        uids, labels = (np.atleast_1d(anchors[c]) for c in ("uid", "label"))
        values = anchors["values"] if "values" in anchors else query_of(anchors["vec"], dims, scale)
        super().__init__(uids, labels, values, k, np.full((1, len(uids)), -np.inf), np.full((1, len(uids)), np.inf))

    def apart(self, block, at, who):
        if isinstance(at, slice):
            at, who = np.arange(at.start, at.stop)[:, None], who[None, :]
        return (block.labels[at] == self.labels[who]) & (block.uids[at] != self.uids[who])

    def see(self, block: Block) -> None:
        self.scan(block, self.span(block), True)


class Negatives(Search):
    """First ``k`` rows of other labels inside the score window of each positive, over the blocks seen so far."""

    def __init__(self, anchors: dict, dims: int, scale: int, k: int, window: tuple[int, int]):
        positives = anchors["positives"]                                        # (windows, anchors); none: the least long
        none = positives == np.iinfo(np.int64).min
        score = np.where(none, 0, positives)
        low = np.where(none, np.inf, -(-window[0] * score // 100))              # whole scores, both ends in
        high = np.where(none, -np.inf, window[1] * score // 100)
        low, high = np.where(low > high, np.inf, low), np.where(low > high, -np.inf, high)
        super().__init__(anchors["uid"], anchors["label"], anchors["values"], k, low, high)

    def apart(self, block, at, who):
        if isinstance(at, slice):
            at, who = np.arange(at.start, at.stop)[:, None], who[None, :]
        return block.labels[at] != self.labels[who]

    def see(self, block: Block) -> None:
        mixed = self.span(block)
        self.scan(block, slice(0, mixed.start), False)
        if self.labels.min() < self.labels.max():
            self.scan(block, mixed, True)
        self.scan(block, slice(mixed.stop, len(block.ids)), False)


def query_of(vec: list, dims: int, scale: int) -> np.ndarray:
    out = np.zeros((1, dims))
    out[0, :len(vec)] = np.floor(scale * np.array(vec, np.float64))
    return out


def groups(pieces: list[pa.Array], dims: int, scale: int, wide: int) -> Iterator[dict]:
    """The anchors of a chunk by label, ``GROUP`` at a time."""
    rows = pa.concat_arrays(pieces)
    uids, labels = (rows.field(c).to_numpy() for c in ("uid", "label"))
    values = matrix(rows.field("vec"), dims, scale)
    found = rows.field("positives")
    positives = np.full((wide, len(uids)), np.iinfo(np.int64).min)
    sizes = pc.list_value_length(found).to_numpy(zero_copy_only=False).astype(np.int64)
    which = np.repeat(np.arange(len(sizes)), sizes)
    positives[np.arange(len(which)) - (np.cumsum(sizes) - sizes)[which], which] = found.flatten().to_numpy(zero_copy_only=False)
    order = np.argsort(labels, kind="stable")
    for at in range(0, len(order), GROUP):
        part = order[at:at + GROUP]
        yield {"uid": uids[part], "label": labels[part], "values": values[part], "positives": positives[:, part]}


def searched(pairs: DataFrame, dims: int, scale: int, wide: int, begin: Callable[[dict], Search]) -> DataFrame:
    """(uid, window, score, vec_id) rows of every anchor in ``tiles``: what one task's blocks hold, at most ``k`` each.

    The anchors of a chunk come first and its blocks follow, so a task keeps its anchors' running results over all its
    blocks and later blocks start from their bounds.
    """
    python_batches(pairs.sparkSession, 1, "64m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, pieces, searches = None, [], []
        for batch in batches:
            for i in range(batch.num_rows):
                at = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py())
                if at != tile:
                    yield from emitted(searches)
                    tile, pieces, searches = at, [], []
                if batch.column(2)[i].is_valid:
                    pieces.append(batch.column(2).slice(i, 1).flatten())
                    continue
                if pieces:
                    searches, pieces = [begin(g) for g in groups(pieces, dims, scale, wide)], []
                block = Block(*(batch.column(k)[i].as_py() for k in range(3, 8)))
                for search in searches:
                    search.see(block)
        yield from emitted(searches)

    return pairs.mapInArrow(run, "uid long, window int, score long, vec_id long")


def emitted(searches: list[Search]) -> Iterator[pa.RecordBatch]:
    for search in searches:
        for uids, windows, scores, ids in search.rows():
            yield pa.RecordBatch.from_arrays(
                [pa.array(uids, pa.int64()), pa.array(windows, pa.int32()), pa.array(scores.astype(np.int64)), pa.array(ids)],
                ["uid", "window", "score", "vec_id"])


def first(rows: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each anchor's window over all tasks, numbered from 1; cut before the shuffle as well."""
    order = Window.partitionBy("uid", "window").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchor: Column, *, label: Column | None = None, id_col: str = "vec_id", vector_col: str = "embedding",
    scale: int = 256, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90),
) -> DataFrame:
    """For each anchor and each of its positives the best rows of other labels inside the positive's score window.

    A component x counts as ``floor(scale * x)``; a score is the inner product with the anchor, higher is better, ties
    go to the smaller id. Positives are the first other rows of the anchor's label. A negative's score lies between
    ``window`` percent of its positive's, both ends included, so a positive below zero has none. ``anchor`` is a condition
    on the columns of ``vectors``, ``label`` replaces their column ``label``.

    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score. Rows with a null id, label
    or vector, or with a null or non-finite component, take no part. A vector shorter than the longest one counts as filled
    with zeros. Rows that repeat an id are rows of their own: each one that is an anchor gives its rows, and the others
    can be positives and negatives. Scores past 2**53 raise. An empty table, or one without anchors, gives an empty
    result; other columns are ignored. Vectors are packed where they lie and a chunk of anchors meets every block, so
    neither a label nor an anchor gathers rows in one task, and all results are cut to ``positives`` or ``negatives`` a task.
    """
    rows = usable(vectors, id_col, vector_col, F.col("label") if label is None else label, anchor)
    count, dims = rows.agg(F.count(F.when(F.col("anchor"), 1)), F.max(F.size("vec"))).first()
    dims = dims or 0
    at_once = max(1, min(ANCHORS_AT_ONCE, ANCHOR_VALUES // max(dims, 1)))
    chunks = max(1, -(-count // at_once), min(CHUNKS, count // GROUP))
    pieces = max(1, -(-count // (chunks * PIECE)))
    packed = saved(blocks(rows, dims, scale), "blocks")
    anchors = rows.where("anchor").select("uid", "vec_id", "label", "vec")

    met = tiles(packed, anchors.withColumn("positives", F.array().cast("array<bigint>")), chunks, pieces)
    near = searched(met, dims, scale, 0, lambda a: Nearest(a, dims, scale, positives))
    near = first(saved(near, "near"), positives)
    found = near.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("positives"))
    asked = saved(anchors.join(found, "uid"), "asked")

    met = tiles(packed, asked.withColumn("positives", F.col("positives.score")), chunks, pieces)
    apart = searched(met, dims, scale, positives, lambda a: Negatives(a, dims, scale, negatives, window))
    apart = first(saved(apart, "apart"), negatives).withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
    which = asked.select("uid", F.col("vec_id").alias("anchor_id"), F.posexplode("positives").alias("window", "positive"))
    return apart.join(which, ["uid", "window"]).select(
        "anchor_id", F.col("positive.vec_id").alias("positive_id"), "rank", "negative_id",
        F.col("positive.score").alias("positive_score"), "negative_score")
