"""The Feistel shuffle against its computed places, on awkward and repeated rows."""

import zlib

import pytest
from pyspark.sql import functions as F

from panelwright.llm import sharding
from panelwright.llm.common import table
from tests.llm.conftest import AWKWARD


@pytest.mark.parametrize("rows", [1, 2, 3, 5, 7, 10, 47, 101, 1000])
@pytest.mark.parametrize("seed", [0, 9])
def test_places_are_a_permutation_that_can_be_computed_and_undone(spark, rows, seed):
    order = sharding.Permutation(rows, seed)
    got = {r["id"]: r["place"] for r in order.place(spark.range(rows), "id", "place").collect()}
    assert got == {i: order.place_of(i) for i in range(rows)}
    assert sorted(got.values()) == list(range(rows))
    assert all(order.row_at(p) == i for i, p in got.items())
    assert rows < 47 or got != {i: sharding.Permutation(rows, seed + 1).place_of(i) for i in range(rows)}


def checked(rows, docs, shards):
    """Sizes, checksums, even shards and slots without gaps; shard and slot follow from the row number."""
    want = sorted((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs if i is not None)
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in rows if r["doc_id"] is not None) == want
    assert len(rows) == len(docs) and sorted(r["row"] for r in rows) == list(range(len(docs)))
    by = {s: sorted(r["slot"] for r in rows if r["shard"] == s) for s in range(shards)}
    assert all(slots == list(range(len(slots))) for slots in by.values())
    counts = [len(s) for s in by.values()]
    assert max(counts) - min(counts) <= 1
    for r in rows:
        assert sharding.locate(r["row"], len(docs), shards) == (r["shard"], r["slot"])
        assert sharding.row_of(r["shard"], r["slot"], len(docs), shards) == r["row"]


def test_awkward_rows_and_clashing_columns(docs_of):
    docs = docs_of(AWKWARD, shard="x", slot=1, row=2, size=3)
    checked(sharding.dealt(docs, 8, keep=docs.columns).collect(), [(i, t) for i, t, *_ in AWKWARD], 8)
    assert sharding.dealt(docs.limit(0), 8).count() == 0


def test_most_rows_are_one_row_repeated(docs_of):
    rows = [(5, "copy")] * 200 + [(k, f"own {k}") for k in range(50)]
    checked(sharding.dealt(docs_of(rows), 3).collect(), rows, 3)


def test_reruns_and_other_layouts_of_the_input_agree(spark, sf):
    docs = table(spark, sf, "documents")
    one, two = (sorted(map(tuple, sharding.dealt(d, 8).collect())) for d in (docs, docs.repartition(7, "text")))
    assert one == two
    assert one != sorted(map(tuple, sharding.dealt(docs, 8, seed=1).collect()))


def test_no_python_in_the_plan(spark, sf):
    plan = sharding.dealt(table(spark, sf, "documents"), 8)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_shards_are_files_in_slot_order(spark, sf, tmp_path):
    docs = table(spark, sf, "documents")
    sharding.write_shards(docs, str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.select(*docs.columns).exceptAll(docs).isEmpty() and back.count() == docs.count()
    for shard in range(4):
        one = spark.read.parquet(str(tmp_path / "shards" / f"shard={shard}")).select(F.input_file_name().alias("f"), "slot").collect()
        for f in {r["f"] for r in one}:
            slots = [r["slot"] for r in one if r["f"] == f]
            assert slots == sorted(slots)
