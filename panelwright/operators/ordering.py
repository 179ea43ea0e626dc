"""Exact global order statistics without pulling a table into one task.

Spark runs ``row_number() over (order by x)`` and ``percentile`` of a whole
table on a single task. The functions here cut the value range with an
approximate histogram (a few numbers per group) and then work exactly inside
the pieces. All are lazy, and exact: the histogram only decides where to cut.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from panelwright.functions.cleaning import seeded_hash

C = F.col
ACCURACY = 10_000          # rank error of percentile_approx is at most n / ACCURACY


def _doubles(values: Sequence[float]) -> Column:
    """Literal array of doubles, built in one call."""
    return F.expr(f"array({', '.join(f'{float(v)!r}D' for v in values)})")


def join_null_safe(df: DataFrame, side: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys meet each other, so that no row with a null group is lost."""
    renamed = side.withColumnsRenamed({c: f"__side_{c}" for c in on})
    met = reduce(lambda a, b: a & b, [C(c).eqNullSafe(C(f"__side_{c}")) for c in on])
    return df.join(renamed, met, how).drop(*[f"__side_{c}" for c in on])


def _with_side(df: DataFrame, side: DataFrame, by: Sequence[str], few: bool = False) -> DataFrame:
    """Attach a per-group table: a one-row table, or one with few groups by construction, is broadcast; another
    keyed one is left to the planner, which measures it first."""
    if not by:
        return df.crossJoin(F.broadcast(side))
    return join_null_safe(df, F.broadcast(side) if few else side, by)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Mapping[str, float],
    by: Sequence[str] = (),
    few: bool = False,
) -> DataFrame:
    """Linear-interpolated quantiles, one output column per name in ``probs``.

    ``few`` says that the groups are few by construction (columns, tiers, classes): their sizes are then broadcast,
    as a shuffle of the rows on such a key would go to as few tasks.

    Two passes. The first brackets each wanted rank with approximate quantiles.
    The second counts rows below each bracket (collapsed map-side to one row)
    and keeps a value -> count histogram of the bracket, whose size is about
    6/ACCURACY of the rows; the wanted order statistics are read off it. Groups
    below 2 * ACCURACY rows are their own bracket. A bracket that misses its
    rank raises instead of answering wrongly.
    """
    by = list(by)
    names = list(probs)
    ps = [float(probs[n]) for n in names]
    margin = 3.0 / ACCURACY
    cuts = [min(max(p + s, 0.0), 1.0) for p in ps for s in (-margin, margin)]

    rows = df.select(*by, C(value).cast("double").alias("__v")).where(C("__v").isNotNull())
    edges = F.percentile_approx("__v", _doubles(cuts), F.lit(ACCURACY)).alias("__e")
    sizes = rows.groupBy(*by).agg(F.count("__v").alias("__n"), edges)

    def slot(i: int) -> Column:
        low, high = C("__e")[2 * i], C("__e")[2 * i + 1]
        small = C("__n") < 2 * ACCURACY              # one rank is more than the margin: keep all
        key = F.when(small | (C("__v") >= low), C("__v"))      # below the bracket: one null key
        return F.when(small | (C("__v") <= high), F.struct(F.lit(i).alias("i"), key.alias("v")))

    marked = _with_side(rows, sizes, by, few).select(
        *by, "__n", F.explode(F.array_compact(F.array(*[slot(i) for i in range(len(ps))]))).alias("__s")
    )
    histogram = marked.groupBy(*by, "__n", C("__s.i").alias("__i"), C("__s.v").alias("__v")).agg(
        F.count(F.lit(1)).alias("__c")
    )
    upto = Window.partitionBy(*by, "__i").orderBy(C("__v").asc_nulls_first())
    ranked = histogram.withColumn("__cum", F.sum("__c").over(upto.rowsBetween(Window.unboundedPreceding, 0)))

    position = F.element_at(_doubles(ps), C("__i") + 1) * (C("__n") - 1)
    below, above = F.floor(position), F.ceil(position)
    stat = lambda k: F.min(F.when(C("__cum") > k, F.struct("__cum", C("__v").alias("v"))))["v"]
    picked = ranked.withColumns({"__pos": position, "__lo": below, "__hi": above}).groupBy(*by, "__i").agg(
        stat(C("__lo")).alias("__a"),
        stat(C("__hi")).alias("__b"),
        F.first("__pos").alias("__pos"),
        F.first("__lo").alias("__lo"),
    )
    answer = C("__a") + (C("__b") - C("__a")) * (C("__pos") - C("__lo"))
    guarded = F.when(C("__a").isNotNull() & C("__b").isNotNull(), answer).otherwise(
        F.raise_error(F.lit("quantile bracket missed its rank")).cast("double")
    )
    wide = [F.max(F.when(C("__i") == i, C("__q"))).alias(n) for i, n in enumerate(names)]
    return picked.withColumn("__q", guarded).groupBy(*by).agg(*wide)


def exact_median(df: DataFrame, value: str, name: str, by: Sequence[str] = (), few: bool = False) -> DataFrame:
    return exact_quantiles(df, value, {name: 0.5}, by, few)


STRIDE = 32                # cut points compared at each of two levels


def _edges_before(i: int, value: str, descending: bool) -> Column:
    """How many cut points come strictly before the value in the given order; nulls come after all of them.

    Compared in the value's own type, and at two levels: every STRIDE-th cut point, then those of one stretch.
    """
    v, edges = C(value), C(f"__e{i}")
    passed = (lambda e: e <= v) if descending else (lambda e: e < v)
    start = F.size(F.filter(f"__c{i}", passed)) * STRIDE
    upto = start + F.size(F.filter(F.slice(edges, start + 1, STRIDE), passed))
    before = F.size(edges) - upto if descending else upto
    return F.when(v.isNull(), F.size(edges) + 1).otherwise(before)


def bucket_count(df: DataFrame) -> int:
    """Enough range buckets for the session's parallelism, within [16, 1024]."""
    return max(16, min(1024, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def _cut_points(df: DataFrame, columns: Mapping[str, int], unique: str, by: Sequence[str] = ()) -> DataFrame:
    """Arrays of cut points ``__e0, __e1, ...`` per group, from a hash sample.

    Two branches of a plan use the same cut points, so they must come out the
    same however tasks are scheduled or retried. Rows are therefore sampled by
    a hash of their unique value (about 20 rows per bucket, at least 2,000),
    and the cut points are taken from that bounded sample in the columns' own
    types; an approximate sketch would depend on the order in which partial results arrive. Groups no larger
    than the sample need no cut points and get no row here: read them through
    ``_with_cuts``.
    """
    by = list(by)
    wanted = max(2_000, 20 * max(columns.values()))
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"))
    uniform = F.pmod(F.xxhash64(C(unique)), F.lit(1 << 31)) / F.lit(float(1 << 31))
    kept = _with_side(df.select(*by, *dict.fromkeys([*columns, unique])), sizes.where(C("__n") > wanted), by).where(
        uniform * C("__n") < wanted
    )
    drawn = kept.groupBy(*by).agg(*[F.array_sort(F.collect_list(C(c))).alias(f"__s{i}") for i, c in enumerate(columns)])

    def points(i: int, n: int) -> Column:
        sample = C(f"__s{i}")
        at = F.transform(F.sequence(F.lit(1), F.lit(n - 1)), lambda k: F.floor(k * F.size(sample) / n).cast("int"))
        return F.array_distinct(F.array_compact(F.transform(at, lambda k: F.get(sample, k)))).alias(f"__e{i}")

    edges = drawn.select(*by, *[points(i, n) for i, n in enumerate(columns.values())])
    return edges.withColumns({
        f"__c{i}": F.filter(f"__e{i}", lambda e, k: k % STRIDE == STRIDE - 1) for i in range(len(columns))
    })


def _with_cuts(df: DataFrame, cuts: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Attach cut points; rows of small groups get empty arrays, i.e. one bucket."""
    joined = join_null_safe(df, cuts, by, "left") if by else df.crossJoin(F.broadcast(cuts))
    empty = {}
    for i, c in enumerate(columns):
        none = F.array().cast(f"array<{df.schema[c].dataType.simpleString()}>")
        empty |= {f"__e{i}": F.coalesce(C(f"__e{i}"), none), f"__c{i}": F.coalesce(C(f"__c{i}"), none)}
    return joined.withColumns(empty)


def exact_medians(df: DataFrame, columns: Sequence[str], prefix: str = "") -> DataFrame:
    """One row with the exact median of every listed column, in two passes over
    the table whatever the number of columns: the columns become groups."""
    long = df.select(*[C(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "__column", "__value")
    per = exact_median(long, "__value", "__median", by=["__column"], few=True)
    return per.agg(*[F.max(F.when(C("__column") == c, C("__median"))).alias(f"{prefix}{c}") for c in columns])


def _last_nulls(column: str, descending: bool) -> Column:
    return C(column).desc_nulls_last() if descending else C(column).asc_nulls_last()


def running_totals(
    df: DataFrame,
    order: str,
    sums: Mapping[str, str],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Inclusive running sums over a global (or per-group) order.

    ``df`` must hold one row per (by, order) - aggregate first, which is also
    what removes hot values. Each bucket is summed on its own; the totals of
    the buckets before it are added back. A null order value comes last in
    either direction; null groups are groups.
    """
    by = list(by)
    # Cut points exist for large groups only; the planner sizes that join.
    cut = _with_cuts(df, _cut_points(df, {order: bucket_count(df)}, order, by), by, [order])
    cut = cut.withColumn("__b", _edges_before(0, order, descending)).drop("__e0", "__c0")

    totals = cut.groupBy(*by, "__b").agg(*[F.sum(src).alias(f"__t_{out}") for out, src in sums.items()])
    # At most 1,024 buckets per group meet in this window.
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "__b", *[F.coalesce(F.sum(f"__t_{o}").over(before), F.lit(0)).alias(f"__o_{o}") for o in sums]
    )
    within = Window.partitionBy(*by, "__b").orderBy(_last_nulls(order, descending)).rowsBetween(Window.unboundedPreceding, 0)
    summed = cut.withColumns({f"__w_{out}": F.sum(src).over(within) for out, src in sums.items()})
    joined = join_null_safe(summed, offsets, [*by, "__b"])
    out = {o: C(f"__w_{o}") + C(f"__o_{o}") for o in sums}
    return joined.withColumns(out).select(*df.columns, *sums)


def attach_percentile_rank(df: DataFrame, source: DataFrame, value: str, name: str) -> DataFrame:
    """Average rank over n of ``value`` within ``source``, joined onto ``df``.

    Works on (value, count): a value held by a third of the rows is one row
    here. The join back to the rows is an equi-join whose skew AQE splits.
    """
    counts = source.groupBy(C(value).alias("__val")).agg(F.count(F.lit(1)).alias("__c"))
    total = source.agg(F.count(F.lit(1)).alias("__total"))
    cum = running_totals(counts, "__val", {"__cum": "__c"})
    ranks = cum.crossJoin(F.broadcast(total)).select(
        "__val", ((C("__cum") - C("__c") + (C("__c") + 1) / 2) / C("__total")).alias(name)
    )
    return df.join(ranks, C(value).eqNullSafe(C("__val")), "left").drop("__val")


def percentile_rank_avg(df: DataFrame, value: str, name: str) -> DataFrame:
    """Average rank over n, ties sharing the mean rank. Values must not be null."""
    return attach_percentile_rank(df, df, value, name)


def global_row_number(df: DataFrame, keys: Sequence[tuple[str, bool]], tie: str, name: str = "rank") -> DataFrame:
    """``row_number()`` over a whole-table order, computed in parallel.

    ``keys`` are (numeric column, descending); remaining ties are broken by the
    md5 of ``tie`` (unique). A row's bucket is its place among the cut points of
    the first key; a value that *is* a cut point (the heavy ones) gets a bucket
    of its own, cut further by the next key and finally by two hex digits of
    the digest. So no single value, however frequent, lands in one task, and
    the number of buckets is bounded whatever the table holds. Nulls come last
    in either direction and are cut like a heavy value. Materialize a costly or floating-point input first: it is read by
    several branches.
    """
    cols = [k for k, _ in keys]
    sizes = {c: bucket_count(df) if i == 0 else 8 for i, c in enumerate(cols)}
    edges = _cut_points(df, sizes, tie)
    cut = _with_cuts(df, edges, [], cols).withColumn("__h", F.md5(C(tie).cast("string")))

    path, live = {}, F.lit(True)
    for i, (c, desc) in enumerate(keys):
        passed = _edges_before(i, c, desc)
        on_edge = C(c).isNull() | F.coalesce(F.array_contains(f"__e{i}", C(c)), F.lit(False))
        path[f"__b{i}"] = F.when(live, 2 * passed + on_edge.cast("int")).otherwise(F.lit(-1))
        live = live & on_edge
    path["__bh"] = F.when(live, F.conv(F.substring("__h", 1, 2), 16, 10).cast("int")).otherwise(F.lit(-1))
    cut = cut.withColumns(path).drop(*[f"__{kind}{i}" for i in range(len(cols)) for kind in "ec"])

    levels = list(path)
    counts = cut.groupBy(*levels).agg(F.count(F.lit(1)).alias("__n"))
    # Bounded by the cut points, not by the table.
    before = Window.partitionBy(F.lit(0)).orderBy(*levels).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*levels, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    order = [_last_nulls(c, d) for c, d in keys] + [C("__h"), C(tie)]
    within = Window.partitionBy(*levels).orderBy(*order)
    ranked = cut.withColumn("__inner", F.row_number().over(within)).join(offsets, levels)
    return ranked.withColumn(name, (C("__inner") + C("__off")).cast("bigint")).drop(*levels, "__h", "__inner", "__off")


def hashed_row_number(
    df: DataFrame, tie: str, seed: int | str, by: Sequence[str] = (), name: str = "rn"
) -> DataFrame:
    """Row number in seeded random order, per group.

    Digests are uniform, so their first two hex digits cut even a group that
    holds most of the table into 256 equal pieces without looking at the data.
    """
    by = list(by)
    cut = df.withColumn("__h", seeded_hash(tie, seed)).withColumn("__b", F.substring("__h", 1, 2))
    counts = cut.groupBy(*by, "__b").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    within = Window.partitionBy(*by, "__b").orderBy("__h", tie)
    ranked = join_null_safe(cut.withColumn("__inner", F.row_number().over(within)), offsets, [*by, "__b"])
    return ranked.withColumn(name, (C("__inner") + C("__off")).cast("bigint")).drop("__h", "__b", "__inner", "__off")


def top_k(df: DataFrame, keys: Sequence[tuple[str, bool]], tie: str, k: int) -> DataFrame:
    """First k rows of a total order (TakeOrderedAndProject: k rows per task)."""
    order = [_last_nulls(c, d) for c, d in keys]
    return df.orderBy(*order, F.md5(C(tie).cast("string")), C(tie)).limit(k)


def rank_top(df: DataFrame, keys: Sequence[tuple[str, bool]], tie: str, k: int, name: str = "rank") -> DataFrame:
    """Top k with its rank; the window runs over k rows only."""
    order = [_last_nulls(c, d) for c, d in keys]
    w = Window.partitionBy(F.lit(0)).orderBy(*order, F.md5(C(tie).cast("string")), C(tie))
    return top_k(df, keys, tie, k).withColumn(name, F.row_number().over(w).cast("bigint"))


def capped_top(
    df: DataFrame, group: str, score: str, tie: str, per_group: int, n: int, name: str = "rank"
) -> DataFrame:
    """Top n overall with at most ``per_group`` rows per group.

    Equals the greedy walk down the ranking. The per-group filter is pruned on
    the map side, so a group holding most of the table ships few rows.
    """
    w = Window.partitionBy(group).orderBy(C(score).desc(), F.md5(C(tie).cast("string")), C(tie))
    allowed = df.withColumn("__g", F.row_number().over(w)).where(C("__g") <= per_group).drop("__g")
    return rank_top(allowed, [(score, True)], tie, n, name)


def minmax_normalize(df: DataFrame, value: str, name: str) -> DataFrame:
    """(x - min) / (max - min); 0 for a constant column; null counts as 0."""
    v = F.coalesce(C(value).cast("double"), F.lit(0.0))
    bounds = df.agg(F.min(v).alias("__lo"), F.max(v).alias("__hi"))
    scaled = F.when(C("__hi") > C("__lo"), (v - C("__lo")) / (C("__hi") - C("__lo"))).otherwise(F.lit(0.0))
    return df.crossJoin(F.broadcast(bounds)).withColumn(name, scaled).drop("__lo", "__hi")


def quantile_bins(df: DataFrame, value: str, n: int, name: str) -> DataFrame:
    """Equal-count bins numbered from 0; equal values always share a bin and
    repeated edges are merged, so fewer bins than ``n`` may come out."""
    probs = {f"__p{i}": i / n for i in range(0, n + 1)}
    edges = exact_quantiles(df, value, probs)
    inner = F.array_sort(F.array_distinct(F.array(*[C(p) for p in probs])))
    edges = edges.select(inner.alias("__edges"))
    # (e0, e1] is bin 0 and its left end is included.
    bin_of = F.greatest(F.size(F.filter("__edges", lambda e: e < C(value))) - 1, F.lit(0))
    return df.crossJoin(F.broadcast(edges)).withColumn(name, bin_of.cast("int")).drop("__edges")


def attach_group_median(df: DataFrame, group: str, values: Mapping[str, str], few: bool = False) -> DataFrame:
    """Add each row's group median per (output name -> column); rows with a null group share one.

    ``few``: the groups are few by construction, so what is joined to the rows is broadcast."""
    long = df.select(group, *[C(v).cast("double").alias(n) for n, v in values.items()]).unpivot(
        [group], list(values), "__column", "__value"
    )
    per = exact_median(long, "__value", "__median", by=[group, "__column"], few=few)
    wide = per.groupBy(group).agg(
        *[F.max(F.when(C("__column") == n, C("__median"))).alias(n) for n in values]
    )
    return join_null_safe(df, F.broadcast(wide) if few else wide, [group], "left")


def sample_n(df: DataFrame, tie: str, n: int, seed: int | str) -> DataFrame:
    """Fixed-size sample without replacement: the n smallest digests."""
    return df.orderBy(seeded_hash(tie, seed), tie).limit(n)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
