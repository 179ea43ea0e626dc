"""Hard negatives against plain Python over all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.llm import hard_negatives
from panelwright.llm.hard_negatives import Block, Nearest

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), T.StructField("uid", T.StringType()), T.StructField("score", T.StringType())])


def brute(rows, every=10, k=5, n=10):
    rows = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows
            if i is not None and v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (i, v, lab) in enumerate(rows):
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m) for b, (j, w, m) in enumerate(rows) if b != at)
        for p, j, m in [s for s in scored if s[2] == lab][:k]:
            inside = [(s, x) for s, x, m in scored if m != lab and 30 * -p <= 100 * -s <= 90 * -p][:n]
            out += [(i, j, r + 1, x, -p, -s) for r, (s, x) in enumerate(inside)]
    return sorted(out)


def mined(spark, rows, every=10):
    df = spark.createDataFrame([(*r, "u", "s") for r in rows], SCHEMA).repartition(3)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % every == 0)
    return sorted(map(tuple, got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()))


def f32(rng, dims, spread=1.0):
    return [round(rng.gauss(0, spread) * 1024) / 1024 for _ in range(dims)]


@pytest.mark.parametrize("dims", [1, 3, 20])
def test_equals_all_pairs(spark, monkeypatch, dims):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 40)
    monkeypatch.setattr(hard_negatives, "ANCHORS_AT_ONCE", 5)       # several chunks
    rng = random.Random(dims)
    rows = [(i, f32(rng, dims), rng.choice([1, 1, 1, 2, 3])) for i in range(300)]
    want = brute(rows)
    assert want and mined(spark, rows) == want


def test_ties_repeats_nulls_and_short_vectors(spark):
    rng = random.Random(4)
    same = f32(rng, 4)
    rows = [(i, same if i % 3 else f32(rng, 4), i % 2) for i in range(80)]
    rows += [(10, f32(rng, 4), 0), (10, same, 1), (11, same, 1)]                       # ids that repeat
    rows += [(None, same, 1), (90, None, 1), (90, same, None), (90, [None, 1.0], 1), (90, [math.inf], 1), (90, [math.nan], 0)]
    rows += [(100, [], 1), (101, [0.5], 0), (102, same[:2], 1)]
    want = brute(rows)
    assert want and mined(spark, rows) == want


def test_scores_of_zero_and_below(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [-1.0, 0.0], 1), (3, [0.0, -1.0], 2), (4, [-0.5, 0.0], 2)]
    assert mined(spark, rows) == brute(rows) == [(0, 1, 1, 3, 0, 0)]


def test_nothing_and_no_anchor(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (3, [2.0], 1)]) == []
    assert mined(spark, [(10, [], 1), (11, [], 1), (12, [], 2)]) == brute([(10, [], 1), (11, [], 1), (12, [], 2)])


def test_scores_too_large_to_be_exact_raise(spark):
    with pytest.raises(Exception, match="2\\*\\*53"):
        mined(spark, [(0, [1e30], 1), (1, [1e30], 1), (2, [1.0], 2)])


def test_bounds_drop_rows_before_the_last_dimension():
    import numpy as np
    rng = np.random.default_rng(1)
    columns = np.where(rng.random((64, 2000)) < 0.03, 500, 0).astype(np.int32)
    columns[:, 7] = 500
    block = Block(np.arange(2000).tobytes(), np.arange(2000).tobytes(), np.zeros(2000, np.int64).tobytes(), columns.tobytes())
    anchor = {"uid": -1, "label": 0, "vec": [1 / (k + 1) for k in range(64)]}
    looks = []
    search = Nearest(anchor, 64, 256, 1)
    scan = block.scan

    def watched(query, live, wanted):
        return scan(query, live, lambda lower, upper, among: looks.append(len(lower)) or wanted(lower, upper, among))

    block.scan = watched
    search.see(block)
    assert search.ids.tolist() == [7] and looks[0] == 2000 and looks[-1] < 20


def test_anchors_share_a_look_at_a_block(spark, monkeypatch):
    """A group of anchors meets a block in a few matrix products, not one scan an anchor."""
    import numpy as np
    rng = np.random.default_rng(2)
    values, labels = rng.integers(-90, 90, (1000, 16)), np.sort(rng.integers(0, 3, 1000))
    uids = np.arange(1000)
    block = Block(*(x.astype(np.int64).tobytes() for x in (uids, uids, labels)), values.T.astype(np.int16).tobytes(), 2)
    scans, scan = [], block.scan
    block.scan = lambda *a: scans.append(1) or scan(*a)
    group = {"uid": uids[::4], "label": labels[::4], "values": values[::4]}
    near = Nearest(group, 16, 256, 5)
    near.see(block)
    near.settle()
    positives = near.scores[0].T.astype(np.int64)
    apart = hard_negatives.Negatives({**group, "positives": positives}, 16, 256, 10, (30, 90))
    apart.see(block)
    apart.settle()
    assert len(scans) <= 12 < len(uids[::4])
    scores = values @ values.T
    for a, u in enumerate(uids[::4]):
        same = sorted((-scores[u, i], i) for i in uids if labels[i] == labels[u] and i != u)[:5]
        assert [(-s, i) for s, i in same] == list(zip(near.scores[0, a], near.all_ids[0, a]))
        for w, (p, _) in enumerate(same):
            inside = sorted((-scores[u, i], i) for i in uids if labels[i] != labels[u] and -30 * p <= 100 * scores[u, i] <= -90 * p)[:10]
            found = apart.scores[w, a] > -np.inf
            assert [(-s, i) for s, i in inside] == list(zip(apart.scores[w, a][found], apart.all_ids[w, a][found]))


@pytest.mark.parametrize("spread", [0.3, 40.0, 3000.0])
def test_scores_of_any_size_over_many_groups(spark, monkeypatch, spread):
    """Whole scores beyond what single floats hold, in groups of several labels."""
    monkeypatch.setattr(hard_negatives, "GROUP", 7)
    monkeypatch.setattr(hard_negatives, "FIRST_PAIRS", 70)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 64)
    rng = random.Random(int(spread))
    rows = [(i, f32(rng, 12, spread), rng.choice([1, 2, 2, 3])) for i in range(400)]
    want = brute(rows, every=5)
    assert want and mined(spark, rows, every=5) == want
