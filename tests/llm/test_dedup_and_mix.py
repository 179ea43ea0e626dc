"""Exact deduplication and source mixing against plain Python."""

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelwright.llm import exact_dedup, mixing
from panelwright.llm.common import table
from tests.llm.conftest import AWKWARD


def brute_dedup(rows):
    groups = defaultdict(list)
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t, *_ in rows]
    for i, t in norm:
        groups[t].append(i)
    out = []
    for i, t in norm:
        ids = [x for x in groups[t] if x is not None]
        keep = min(ids) if ids else None
        out.append((i, keep, len(groups[t]), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return out


def rows_of(df):
    got = df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    return sorted((tuple(r) for r in got), key=repr)


@pytest.mark.parametrize("digest", [exact_dedup.content_hash, lambda t: F.length(t) % 2])
def test_dedup_equals_brute_force_even_when_hashes_collide(docs_of, digest):
    rows = AWKWARD + [(100 + k, f"copy {k % 3}  of\ttext") for k in range(12)]
    got = exact_dedup.deduplicate(docs_of(rows, keep_id=5, group_size="x"), digest=digest)
    assert rows_of(got) == sorted(brute_dedup(rows), key=repr)


@pytest.mark.parametrize("ids", [[None] * 6, [None, 4, 4, None, 2, 2]])
def test_dedup_compares_bytes_without_ids_and_in_slices(docs_of, monkeypatch, ids):
    monkeypatch.setattr(exact_dedup, "SLICE_ROWS", 1)
    rows = list(zip(ids, ["a", "b", "a", "c", "c", "c"])) + [(100 + k, "abc"[k % 3]) for k in range(30)]
    got = exact_dedup.deduplicate(docs_of(rows), digest=lambda t: F.lit(0))
    want = brute_dedup(rows)
    if None in ids[:1] and set(ids) == {None}:
        assert rows_of(got) == sorted(want, key=repr)
    else:                                                   # ids that repeat: classes and sizes
        assert sorted((r[2], r[4]) for r in rows_of(got)) == sorted((r[2], r[4]) for r in want)
    alone = exact_dedup.deduplicate(docs_of([(None, t) for t in "aba"]), digest=lambda t: F.lit(0))
    assert sorted(r["group_size"] for r in alone.collect()) == [1, 2, 2]


def test_weights_without_a_schedule_are_spent_evenly(docs_of):
    docs = docs_of([(k, "w " * 10, "en", f"s{k % 2}") for k in range(40)])
    copies = [c for r in mixing.mix(docs, weights=(1, 5)).collect() for c in r["copies"] if r["source"] == "s1"]
    places = sorted(c["position"] for c in copies)
    assert places[0] == 0 and places == pytest.approx([k / len(places) for k in range(len(places))], abs=0.06)


def test_dedup_of_nothing(docs_of):
    assert exact_dedup.deduplicate(docs_of([(1, "x")]).limit(0)).count() == 0


def test_mix_meets_its_targets(spark, sf):
    docs = table(spark, sf, "documents")
    rows = mixing.mix(docs).collect()
    sizes = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in docs.collect()}
    assert {r["doc_id"]: r["size"] for r in rows} == sizes
    by = defaultdict(lambda: [0, 0, 0.0])
    for r in rows:
        by[r["source"]][0] += r["size"]
        by[r["source"]][1] += r["taken"]
        by[r["source"]][2] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == sum(c["words"] for c in r["copies"])
        assert all(0 <= c["position"] <= 1 for c in r["copies"])
    names = sorted(by)
    total, free, target = sum(v[0] for v in by.values()), set(names), {}
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    while True:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * by[s][0]}
        if not over:
            break
        target |= {s: 3.0 * by[s][0] for s in over}
        free -= over
    target |= {s: level * weight[s] for s in free}
    for s in names:
        assert by[s][2] == pytest.approx(target[s]) and abs(by[s][1] - target[s]) <= 1


def test_mix_caps_small_sources_and_is_repeatable(docs_of):
    rows = [(k, "w " * 50, "en", "big") for k in range(100)] + [(500, "a b c", "en", "tiny"), (501, "d e", "en", None)] + [
        (600, None, "en", "void"), (601, "", "en", "void"), (None, "no id at all", "en", "big")]
    docs = docs_of(rows, size="clash", target=1, taken="x")
    first = sorted(map(tuple, mixing.mix(docs).select("doc_id", "target", "taken").collect()), key=repr)
    again = sorted(map(tuple, mixing.mix(docs.repartition(7)).select("doc_id", "target", "taken").collect()), key=repr)
    assert first == again
    by = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    assert by[500]["taken"] == 9 and by[501]["taken"] == 6 and by[600]["taken"] == 0
    assert mixing.mix(docs.limit(0)).count() == 0


def test_positions_follow_the_schedule(spark):
    ramp = ((0, 0.5), (0.5, 1.0), (1, 3.0))
    shares = [k / 50 for k in range(51)]
    df = spark.createDataFrame([(s,) for s in shares], "s double").select("s", mixing.time_of(F.col("s"), ramp).alias("t"))

    def spent(t):
        steps, total = 4000, 0.0
        rate = lambda x: 0.5 + x if x < 0.5 else 1.0 + (x - 0.5) * 4
        for k in range(steps):
            x = (k + 0.5) * t / steps
            total += rate(x) * t / steps
        return total / (0.375 + 1.0)

    for s, t in map(tuple, df.collect()):
        assert spent(t) == pytest.approx(s, abs=1e-4)


def test_mixed_documents_repeat_and_cut(docs_of):
    rows = [(k, f"doc {k} " + "w " * 40, "en", "big") for k in range(50)] + [(500, "a b c", "en", "tiny"), (501, None, "en", "tiny")]
    docs = docs_of(rows)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    texts = defaultdict(list)
    for r in out.collect():
        texts[r["doc_id"]].append(r["text"])
    assert texts[500] == ["a b c"] * 3 and 501 not in texts
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs).collect()}
    for i, got in texts.items():
        assert sum(len(t.split()) for t in got) == taken[i]


def test_pipeline_mixes_whole_documents(spark, docs_of):
    import corpus_pipeline
    rows = [(k, f"doc {k}\n " + "w " * (k % 7 * 9), "en", f"s{k % 5}") for k in range(60)] + [
        (500, "one  long " + "text " * 400, "en", "long"), (501, "a b c", "en", "tiny"), (502, None, "en", "tiny")]
    docs, texts = docs_of(rows), {i: t for i, t, *_ in rows}
    out = dict(corpus_pipeline.STAGES)["mixing to target weights"](spark, docs, None)
    got = out.collect()
    assert out.columns == docs.columns and all(r["text"] == texts[r["doc_id"]] for r in got)
    mixed, words, longest = mixing.mix(docs).collect(), defaultdict(int), defaultdict(int)
    assert any(c["words"] < r["size"] for r in mixed for c in r["copies"])
    for r in got:
        words[r["source"]] += len(r["text"].split())
    for r in mixed:
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for r in mixed:
        assert abs(words[r["source"]] - r["target"]) <= longest[r["source"]] / 2 + 1
