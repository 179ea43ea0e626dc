"""The streamed filter audit against plain Python, with smaller ids arriving late."""

import re
from collections import Counter
from itertools import permutations

import pandas as pd
import pytest

from panelwright.llm import filter_audit
from panelwright.llm.common import table
from panelwright.llm.queries import QUERIES
from tests.llm.conftest import AWKWARD


def mask_of(doc_id, text, least):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
             bool(re.search(r"[#$%&*|]", text)), doc_id is not None and text in least and least[text] < doc_id]
    return "".join(f for f, bad in zip("ABCDE", fails) if bad)


def brute(docs, labels):
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    good, toxic = ({i for i, *v in labels if v[k] == 1 and i is not None} for k in (0, 1))
    parts = {}
    for i, t, lang in docs:
        parts.setdefault(lang or "", []).append((mask_of(i, t, least), i in good, i in toxic))
    out = {}
    for part, rows in parts.items():
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order):
                left = [r for r in rows if not set(order[:step]) & set(r[0])]
                removed = [r for r in left if f in r[0]]
                shapley[f] += len(removed)
                out[part, order, step + 1] = [
                    len(left) - len(removed), len(removed), sum(f in m for m, *_ in rows) - len(removed),
                    sum(m == f for m, *_ in rows), sum(g for _, g, _ in removed), sum(t for *_, t in removed)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def streamed(spark, path, docs, labels, micro_batches):
    """Each list of ``docs`` is one file; files arrive in the order of their lists."""
    import os
    import time
    for k, rows in enumerate(docs):
        frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang"]).astype({"doc_id": "Int64"})
        frame["mask"], frame["key"] = 1, "clash"
        os.makedirs(path / "documents.parquet", exist_ok=True)
        file = path / "documents.parquet" / f"part-{k:05}.parquet"
        frame.to_parquet(file, index=False)
        os.utime(file, (time.time() - 1000 + 10 * k,) * 2)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    stream = filter_audit.file_stream(spark, str(path / "documents.parquet"), micro_batches)
    got = filter_audit.audit(stream, marks, buckets=3).collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COLUMNS) for r in got}
    assert len(out) == len(got)
    return out


LONG = " ".join(f"word{k}" for k in range(250))
LATE = [
    [(40, "same", "en"), (41, "same", "de"), (42, LONG, "en"), (43, "X#", None), (None, "same", "en")],
    [(30, "same", "de"), (30, "same", "en"), (44, LONG + " ", "en"), (45, None, "fr"), (46, "", "en")],
    [(35, "same", "en"), (20, "same", "en"), (12, LONG, "de"), (None, "same", None), (13, "word " * 300, "en")],
    [(20, "same", "en"), (21, "same", "fr"), (9, "", "de"), (2**60 + 1, LONG, "en"), (2**60, LONG, "fr")],
]
LABELS = [(20, 1, 0), (30, 1, 1), (40, 0, 1), (42, 1, None), (12, None, 1), (12, 1, 0), (None, 1, 1), (9, 1, 0), (2**60, 1, 1)]


@pytest.mark.parametrize("micro_batches", [1, 4])
@pytest.mark.parametrize("turned", [False, True])
def test_retractions_end_in_the_counts_of_the_whole_table(spark, tmp_path, micro_batches, turned):
    docs = LATE[::-1] if turned else LATE
    got = streamed(spark, tmp_path, docs, LABELS, micro_batches)
    assert got == brute([r for rows in docs for r in rows], LABELS)


def test_state_on_disk_gives_the_same(spark, tmp_path, monkeypatch):
    before = {k: spark.conf.get(k, None) for k in filter_audit.ON_DISK}
    monkeypatch.setattr(filter_audit, "IN_MEMORY", 0)
    try:
        assert streamed(spark, tmp_path, LATE, LABELS, 4) == brute([r for rows in LATE for r in rows], LABELS)
        assert "RocksDB" in spark.conf.get(next(iter(before)))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_awkward_rows_and_one_text_everywhere(spark, tmp_path):
    docs = [[(i, t, "en") for i, t, *_ in AWKWARD] + [(1000 - 50 * k - j, "hot", "en") for j in range(40)] for k in range(4)]
    assert streamed(spark, tmp_path, docs, [], 2) == brute([r for rows in docs for r in rows], [])


def test_an_empty_table_has_no_rows(spark, tmp_path):
    assert streamed(spark, tmp_path, [[]], LABELS, 4) == {}


def test_query_equals_brute_force(spark, sf):
    got = QUERIES["op13_filter_audit"](spark, sf).collect()
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in table(spark, sf, "documents").collect()]
    labels = [(r["doc_id"], r["quality"], r["toxic"]) for r in table(spark, sf, "labels").collect()]
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in COLUMNS) for r in got} == brute(docs, labels)
