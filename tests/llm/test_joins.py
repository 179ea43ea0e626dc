"""The n-gram Jaccard join and benchmark decontamination against brute force."""

import hashlib
import random
import re
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelwright.llm import common, decontaminate, set_join
from panelwright.llm.common import table
from tests.llm.conftest import AWKWARD

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    if len(w) < k:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute_components(rows, k, percent):
    sets = {}
    for i, t, *_ in rows:
        sets.setdefault(i, set()).add(shingles(t, k))
    flat = [(i, s) for i, group in sets.items() for s in group]
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, (i, a) in enumerate(flat):
        for j, b in flat[n + 1:]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}, {i: {len(s) for s in group} for i, group in sets.items()}


def near_copies(seed, words=60, copies=25, edits=3):
    """Copies of copies: neighbours are alike, far ones need not be."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    base = [rng.choice(vocabulary) for _ in range(words)]
    out = []
    for _ in range(copies):
        out.append(" ".join(base))
        for _ in range(rng.randint(0, edits)):
            base = base.copy()
            base[rng.randrange(len(base))] = rng.choice(vocabulary)
    return out


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80), (2, 60)])
def test_join_equals_brute_force(docs_of, k, percent):
    texts = [t for s in range(5) for t in near_copies(s, words=20 + 25 * s)] + near_copies(9, 8, 12) + near_copies(10, 14, 12)
    rng = random.Random(3)
    ids = rng.sample(range(1000, 5000), len(texts))
    rows = [r for r in AWKWARD if r[0] is not None] + list(zip(ids, texts)) + list(zip(ids[:5], texts[:5]))
    got = set_join.near_duplicates(docs_of(rows, component_id=1, id="x"), shingle=k, percent=percent).collect()
    comp, sizes = brute_components(rows, k, percent)
    assert len(got) == len(rows)
    for r in got:
        assert r["component_id"] == comp[r["doc_id"]] and r["n_shingles"] in sizes[r["doc_id"]], r


def test_join_of_hot_groups(docs_of, monkeypatch):
    monkeypatch.setattr(set_join, "HOT_GROUP", 3)
    monkeypatch.setattr(set_join, "STAR_ROUNDS", 0)
    rows = list(enumerate(near_copies(1, 80, 60) + near_copies(2, 80, 20) + ["copy of a text"] * 30))
    got = {r["doc_id"]: r["component_id"] for r in set_join.near_duplicates(docs_of(rows), shingle=3, percent=90).collect()}
    assert got == brute_components(rows, 3, 90)[0]


def test_hot_and_other_sets_are_hashed_apart(docs_of, monkeypatch):
    """Keys of all sets were made for the hot ones too, only to be dropped."""
    asked, keys_of = [], set_join.index_keys

    def noted(nodes, *rest):
        asked.append({r["id"] for r in nodes.select("id").collect()})
        return keys_of(nodes, *rest)

    monkeypatch.setattr(set_join, "HOT_GROUP", 3)
    monkeypatch.setattr(set_join, "index_keys", noted)
    rows = list(enumerate(near_copies(1, 80, 60) + [f"a{k} text b{k} alone c{k}" for k in range(8)]))
    got = {r["doc_id"]: r["component_id"] for r in set_join.near_duplicates(docs_of(rows), shingle=3, percent=90).collect()}
    assert got == brute_components(rows, 3, 90)[0]
    others, hot = asked
    firsts = {min(i for i, u in rows if shingles(u, 3) == shingles(t, 3)) for _, t in rows}
    assert hot and others and not hot & others and hot | others == firsts


def test_sets_of_keys_of_any_size_take_one_way(docs_of, monkeypatch):
    """Keys of up to 32 sets had their pairs listed, so that the sets left over grew faster than the table."""
    asked, rare = [], set_join.rare_pairs
    monkeypatch.setattr(set_join, "rare_pairs", lambda nodes, *rest: asked.append(nodes.count()) or rare(nodes, *rest))
    passage = " ".join(f"p{k}" for k in range(12))
    rows = [(i, f"{passage} " + " ".join(f"w{i}_{k}" for k in range(10))) for i in range(28)]
    rows += [(100 + i, f"{t} {i // 4}") for i, t in rows[:8]]
    got = {r["doc_id"]: r["component_id"] for r in set_join.near_duplicates(docs_of(rows), shingle=3, percent=80).collect()}
    assert got == brute_components(rows, 3, 80)[0]
    assert asked and asked[0] >= 5


def test_shingles_are_counted_part_by_part(docs_of, monkeypatch):
    """Rows of all shingles of all sets lay on disk at once, the largest share of the join's disk."""
    made, keep = [], set_join.saved

    def noted(df, name):
        made.append((name, keep(df, name)))
        return made[-1][1]

    monkeypatch.setattr(set_join, "saved", noted)
    passage = " ".join(f"p{k}" for k in range(12))
    rows = [(i, f"{passage} " + " ".join(f"w{i}_{k}" for k in range(10))) for i in range(28)]
    rows += [(100 + i, f"{t} {i // 4}") for i, t in rows[:8]]
    got = {r["doc_id"]: r["component_id"] for r in set_join.near_duplicates(docs_of(rows), shingle=3, percent=80).collect()}
    assert got == brute_components(rows, 3, 80)[0]
    parts = [{r["token"] for r in df.select("token").collect()} for name, df in made if name == "repeated_shingles"]
    assert len(parts) == set_join.SHINGLE_PARTS > 1 and all(parts)
    assert sum(map(len, parts)) == len(set.union(*parts))


def test_saved_tables_leave_no_shuffle_files(spark):
    """Shuffle files stayed until the driver happened to collect garbage."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {f for f in disk.getAllFiles().mkString(" ").split() if "/shuffle_" in f}
    before = files()
    spark.conf.unset(common.FREE_SHUFFLES)
    rows = spark.range(5000).groupBy((F.col("id") % 100).alias("k")).count()
    table = common.saved(rows, "freed")
    until = time.time() + 10
    while files() - before and time.time() < until:
        time.sleep(0.1)
    assert not files() - before
    assert table.count() == 100 and spark.conf.get(common.FREE_SHUFFLES, "false") == "false"


def test_workers_return_what_they_let_go():
    """Freed memory below a block still in use stayed with a worker and came on top of what later stages need."""
    def held():
        with open("/proc/self/status") as file:
            return int(next(line for line in file if line.startswith("RssAnon")).split()[1])

    common.worker_state("one", lambda: [bytes(3000) for _ in range(40_000)])
    top = [bytes(3000) for _ in range(10)]
    full = held()
    common.worker_state("two")
    assert top and full - held() > 60_000                     # kB


@pytest.mark.parametrize("small", [0, 2, 1000])
def test_join_whatever_keys_count_as_small(docs_of, monkeypatch, small):
    monkeypatch.setattr(set_join, "SMALL_KEY", small)
    passage = " ".join(f"p{k}" for k in range(12))               # shared by texts that are not linked otherwise
    rows = list(enumerate([f"{passage} {t}" for s in range(6) for t in near_copies(s, 15 + 10 * s, 8)] + near_copies(7, 90, 30)))
    got = {r["doc_id"]: r["component_id"] for r in set_join.near_duplicates(docs_of(rows), shingle=3, percent=80).collect()}
    assert got == brute_components(rows, 3, 80)[0]


def test_join_of_ids_with_several_texts(docs_of):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice("abcdefghij") + str(rng.randrange(90)) for _ in range(n))
    a, b, c = text(60), text(60), text(60)
    rows = [(1, a), (2, a), (2, b), (3, b + " more"), (4, c), (5, c), (5, a + " more"), (7, text(50)), (7, text(50)), (7, c), (8, text(40))]
    got = set_join.near_duplicates(docs_of(rows), shingle=3, percent=90).collect()
    want = brute_components(rows, 3, 90)[0]
    assert want[3] == want[5] == 1 and {r["doc_id"]: r["component_id"] for r in got} == want and len(got) == len(rows)
    rows += [(9, f"{a} {k}") for k in range(30)]                 # one id with many texts, next to another's
    got = {r["doc_id"]: r["component_id"] for r in set_join.near_duplicates(docs_of(rows), shingle=3, percent=90).collect()}
    assert got == brute_components(rows, 3, 90)[0]


def test_bitmaps_never_differ_by_more_than_their_sets():
    import numpy as np
    rng = np.random.default_rng(2)
    for n, m in ((1, 2), (30, 40), (64, 64), (100, 140), (500, 900), (31, 3000)):
        base = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
        for k in (0, 1, n // 3):
            a, b = base[:n], np.concatenate([base[:n - k], base[3000 - m:]])[:m]
            assert set_join.bits_apart(set_join.parity(a), set_join.parity(b)) <= len(np.setxor1d(a, b))
        assert set_join.bits_apart(set_join.parity(base[:n]), set_join.parity(base[:n])) == 0
    assert set_join.bits_apart(set_join.parity(base[:500]), set_join.parity(base[1000:1500])) > 300


def test_join_edges(docs_of, spark):
    assert set_join.near_duplicates(docs_of([(1, "x")]).limit(0)).count() == 0
    got = {(r["doc_id"], r["component_id"], r["n_shingles"]) for r in set_join.near_duplicates(docs_of([(None, "a b"), (2, None)])).collect()}
    assert got == {(None, None, 1), (2, 2, 0)}


def test_empty_segments_lose_no_pair():
    """Pigeonhole with one-deletion neighbourhoods, on sets so small that segments are often empty."""
    import numpy as np
    rng = np.random.default_rng(5)
    t = set_join.Threshold(70)
    last = t.bands(40)
    for _ in range(4000):
        n = int(rng.integers(4, 30))
        a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([np.delete(a, rng.integers(0, len(a), int(rng.integers(0, 4)))),
                                      rng.integers(0, 1 << 63, int(rng.integers(0, 3)), dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if not len(b) or 100 * both < 70 * (len(a) + len(b) - both) or both == len(a) == len(b):
            continue
        bands = [{int(x) + d for d in (0, 1)} for x in (np.searchsorted(last, len(a)), np.searchsorted(last, len(b)))]
        shared = False
        for band in bands[0] & bands[1]:
            apart = t.most_apart(int(last[band]))
            if apart:
                shared |= bool(set(set_join.segment_keys(a, band, apart)) & set(set_join.segment_keys(b, band, apart)))
        assert shared


def test_word_hashes_do_not_depend_on_where_a_word_stands(monkeypatch):
    texts = ["one two three", "zero one two three", "x" * 50 + " one two three", ""]
    plain = [set(s) for s in set_join.shingle_sets(pa.array(texts), 3, set_join.WordHasher())]
    assert plain[0] <= plain[1] and plain[0] <= plain[2] and not plain[3]
    monkeypatch.setattr(set_join, "CHUNK", 16)
    assert [set(s) for s in set_join.shingle_sets(pa.array(texts), 3, set_join.WordHasher())] == plain


def brute_contamination(docs, items, span=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOW))
    out = []
    for i, text, *_ in docs:
        w, hit, named = words(text), set(), set()
        for item, body in items:
            b = words(body)
            n = min(span, len(b))
            windows = {tuple(b[k:k + n]) for k in range(len(b) - n + 1)} if n else set()
            for k in range(len(w) - n + 1):
                if n and tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    named.add("" if item is None else str(item))
        digest = hashlib.sha256(",".join(sorted(named)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(named), digest, bool(hit)))
    return sorted(out, key=repr)


def contamination_rows(spark, docs_of, rows, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(docs_of(rows, item_id=1, n_hit="x"), bench).drop("row_hash")
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_decontamination_equals_brute_force(spark, docs_of):
    rng = random.Random(8)
    vocabulary = [f"v{k}" for k in range(30)] + ["É", "é", "the"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.choice([10, 11, 14, 40, 300]))) for k in range(12)] + [(50, "v1 v2"), (51, ""), (52, None), (53, "the É v3 v4 v5")]
    rows = list(AWKWARD)
    for k in range(40):
        parts = [text(rng.randint(0, 400))]
        for _ in range(rng.randint(0, 3)):
            source = rng.choice(items)[1] or ""
            w = source.split()
            a = rng.randrange(max(1, len(w)))
            parts += [", ".join(w[a:a + rng.randint(3, 30)]).upper().replace("É", "É"), text(rng.randint(0, 9))]
        rows.append((1000 + k, " ".join(parts)))
    rows += rows[-2:]
    assert contamination_rows(spark, docs_of, rows, items) == brute_contamination(rows, items)


def test_decontamination_edges(spark, docs_of):
    rows = [(1, "a b c d e f g h i j k"), (2, None)]
    assert contamination_rows(spark, docs_of, rows, [(1, None)]) == brute_contamination(rows, [(1, None)])
    bench = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    assert decontaminate.contamination(docs_of(rows).limit(0), bench).count() == 0
    assert decontaminate.contamination(docs_of(rows), bench.limit(0)).where("contaminated").count() == 0
    assert [r["doc_id"] for r in decontaminate.decontaminated(docs_of(rows), bench).collect()] == [2]


@pytest.mark.parametrize("at", [118, 119, 120, 127, 128, 129, 247, 256])
def test_windows_over_block_borders(spark, docs_of, at):
    body = [f"b{k}" for k in range(10)]
    words = [f"x{k}" for k in range(600)]
    rows = [(1, " ".join(words[:at] + body + words[at:]))]
    items = [(7, " ".join(["lead"] * 3 + body + ["tail"]))]
    assert contamination_rows(spark, docs_of, rows, items) == brute_contamination(rows, items)


def test_near_duplicates_on_the_test_tables(spark, sf):
    docs = table(spark, sf, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = {r["doc_id"]: r["component_id"] for r in set_join.near_duplicates(docs, shingle=3, percent=90).collect()}
    assert got == brute_components(rows, 3, 90)[0]
