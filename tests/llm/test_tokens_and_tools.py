"""Token files, tool calls and the pipeline: exact round trips."""

import json
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelwright.llm import decontaminate, language, mixing, queries, set_join, token_files, tool_calls
from panelwright.llm.common import table
from panelwright.session import scratch_path
from tests.compare import connect, mismatch
from tests.llm.conftest import AWKWARD

public_tokenizers = pytest.importorskip("public_tokenizers")
FILE = str(public_tokenizers.path("byte_bpe_50k.json"))


def brute_tokens(rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(FILE)
    out = [(i, t.encode(x or "", add_special_tokens=False).ids + [token_files.END_ID]) for i, x, *_ in rows]
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, len(r[1]), zlib.crc32(np.array(r[1], "<u4").tobytes())))


SPACES = [(30 + k, t) for k, t in enumerate([
    " lead", "trail ", "two  spaces", "a \n b", "x\n y", "tab\t z", "it's we'll I'd", "nbsp  x   y", "<|endoftext|> in text",
    "a" + " " * 9 + "b", "\n\n\n", "é è ê  ", "mixed123 456abc !!??", "end\n ", "𝒳𝒴 漢字 かな", "\x1c \x85 x"])]


def test_token_files_round_trip(spark, docs_of):
    rows = AWKWARD + SPACES
    path = scratch_path(spark, "tokens-test")
    token_files.write_token_files(docs_of(rows, ids="x", n_tokens=1), path, FILE)
    stored = token_files.read_token_files(spark, path)
    want = brute_tokens(rows)
    assert sorted([(r["doc_id"] or -1, list(r["ids"])) for r in stored.collect()]) == sorted((i or -1, x) for i, x in want)
    index = token_files.token_index(stored).collect()
    at, starts = 0, []
    for i, ids in want:
        starts.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted((tuple(r) for r in index), key=repr) == sorted(starts, key=repr)
    assert [r["doc_id"] for r in stored.where("doc_id = 35").collect()] == [35]


def test_token_files_of_nothing(spark, docs_of):
    path = scratch_path(spark, "tokens-empty")
    token_files.write_token_files(docs_of([(1, "x")]).limit(0), path, FILE)
    assert token_files.token_index(token_files.read_token_files(spark, path)).count() == 0


WHITES = [chr(c) for c in (*range(9, 14), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
                           0x205F, 0x3000, 0x200B, 0xFEFF)]
OTHERS = ["a", "lead", "x", "The", "don't", "'s", "'ll", "é", "ß", "漢字", "Ω", "12", "3", "!", "?!", "...", "#", "(", "-", "_", "'", '"',
          "𝒳", "\x00", "ſ", "’", "İ", "Ⅷ", "²", "ª", "_a", "A1", "1a"]


def encoded_alike(encoder, texts):
    import pyarrow as pa
    for a in range(0, len(texts), 500):
        ids, sizes = encoder.encode(pa.array(texts[a:a + 500], pa.string()))
        at = 0
        for text, n in zip(texts[a:a + 500], sizes):
            assert ids[at:at + n].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [2], repr(text)
            at += n


def test_any_white_space_encodes_as_in_the_whole_text():
    rng = random.Random(1)
    piece = lambda: rng.choice([*WHITES, " ", " ", "\n"] if rng.random() < 0.45 else OTHERS)
    texts = ["".join(piece() for _ in range(rng.randint(0, 9))) for _ in range(8000)]
    encoded_alike(token_files.PieceEncoder(FILE, 2), ["x y", "\xa0\xa0lead", *(w + w + "lead" for w in WHITES), *texts])


def test_other_tokenizers_encode_whole_texts(tmp_path):
    import json as js
    with open(FILE, encoding="utf-8") as file:
        kind = js.load(file)
    kind["pre_tokenizer"]["add_prefix_space"] = True
    other = tmp_path / "tokenizer.json"
    other.write_text(js.dumps(kind), encoding="utf-8")
    encoder = token_files.PieceEncoder(str(other), 2)
    assert not encoder.cuts
    encoded_alike(encoder, ["x y", "lead on", "", " a\nb"])


def test_frequent_pieces_beyond_the_memory(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(token_files, "KNOWN_PIECES", 3)
    encoder = token_files.PieceEncoder(FILE, 2)
    for texts in (["one two three four five six", "two three"], ["seven eight two one", ""], ["six  five", None]):
        ids, sizes = encoder.encode(pa.array(texts))
        want = [encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
        assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(w) for w in want]


MIXED = ["the cat, the hat", " lead on\nand (on)", "", None, "two  spaces", "it's we'll!", "Ġ Ġa ĠĠ\nĊ Ċ", "漢字 é, ß", "a\nb\n\nc", "x" * 50 + " y"]


def test_pieces_are_encoded_without_offsets():
    """Offsets and single calls of the tokenizer were a third of the query's time."""
    class Plain:
        def __init__(self, own):
            self.own = own

        def encode_batch_fast(self, *args, **options):
            return self.own.encode_batch_fast(*args, **options)

    encoder = token_files.PieceEncoder(FILE, 2)
    own = encoder.tokenizer
    encoder.tokenizer = Plain(own)
    ids, sizes = encoder.encode(pa.array(MIXED))
    want = [own.encode(t or "", add_special_tokens=False).ids + [2] for t in MIXED]
    assert ids.tolist() == sum(want, []) and sizes.tolist() == [len(w) for w in want]


def test_pieces_that_ids_do_not_tell_apart(monkeypatch):
    monkeypatch.setattr(token_files, "JOINED", 2)
    encoder = token_files.PieceEncoder(FILE, 2)
    encoder.spaced[:], encoder.feed = False, -1
    encoded_alike(encoder, [t or "" for t in MIXED])
    encoded_alike(token_files.PieceEncoder(FILE, 2), [t or "" for t in MIXED])


def test_tool_calls_match_sql(spark, sf):
    assert mismatch(queries.op10_tool_calls(spark, sf), connect(sf), queries.SQL["op10_tool_calls"]) is None


def test_exact_dedup_matches_sql(spark, sf):
    assert mismatch(queries.op9_exact_dedup(spark, sf), connect(sf), queries.SQL["op9_exact_dedup"]) is None


MESSAGES = [
    (1, 0, "call", "a", "f", '{"x": 1, "s": "q"}', None), (1, 1, "result", "a", None, None, "ok"),
    (1, 2, "result", "b", None, None, "early"), (1, 5, "call", "b", "f", '{"s":"z","x":2}', None),
    (1, 6, "call", "c", "f", '{"s":"z","x":"two"}', None), (1, 7, "call", "d", "g", "{}", None), (1, 8, "call", "e", "f", "not json", None),
    (1, 9, "result", "zz", None, None, "orphan"), (1, 10, "message", None, None, None, 'say "hi"\n'), (1, 11, "call", "a", "f", '{"x":3,"s":""}', None),
    (1, 12, "result", "a", None, None, "again"), (2, 0, "call", "a", "f", '{"x":1.5,"s":"q"}', None), (None, 0, "call", "a", "f", None, None),
    (2, None, "message", None, None, None, None), (1, 13, "call", "h", "f", '{"x":1,"s":"q","more":2}', None), (1, 14, "call", None, "f", '{"b":{"d":1,"c":[2,{"z":1,"y":2}]},"a":null}', None),
]


def test_tool_calls_by_hand(spark):
    df = spark.createDataFrame(MESSAGES, "conv_id long, turn long, kind string, call_id string, name string, arguments string, content string")
    rows = tool_calls.linked_messages(df.withColumn("linked", F.lit(1)).drop("linked"), {"f": {"x": "integer", "s": "string"}}).collect()
    assert len(rows) == len(MESSAGES)
    by = {(r["conv_id"], r["turn"]): r for r in rows}
    assert by[1, 0]["linked"] and by[1, 1]["linked"] and by[1, 0]["valid"] and by[1, 1]["valid"]
    assert by[1, 2]["linked"] and (by[1, 2]["place"], by[1, 2]["step"]) == (5, 1)          # moved behind its call
    assert [by[1, t]["valid"] for t in (6, 7, 8, 13, 14)] == [False] * 5
    assert not any(by[1, t]["linked"] for t in (9, 11, 12, 6)) and not by[2, 0]["linked"] and not by[2, 0]["valid"]
    order = [r for r in sorted((r for r in rows if r["conv_id"] == 1), key=lambda r: (r["place"], r["step"], r["turn"]))]
    seen = set()
    for r in order:
        if r["linked"] and r["kind"] == "result":
            assert r["call_id"] in seen
        if r["linked"] and r["kind"] == "call":
            seen.add(r["call_id"])
    for r in rows:
        assert r["line"] == json.dumps(json.loads(r["line"]), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert json.loads(by[1, 0]["line"])["arguments"] == {"s": "q", "x": 1} and json.loads(by[1, 8]["line"])["arguments"] is None
    assert tool_calls.linked_messages(df.limit(0), {"f": {"x": "integer"}}).count() == 0


def test_pipeline_equals_its_stages_by_brute_force(spark, sf):
    """Each stage's rows against plain Python over what the stage before kept."""
    from tests.llm.test_joins import brute_components, brute_contamination
    docs = table(spark, sf, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    stages = dict(corpus_pipeline.STAGES)
    told = stages[names[0]](spark, docs, sf).cache()
    assert told.columns == docs.columns and told.count() >= 0.95 * docs.count()
    one = stages[names[1]](spark, told, sf).cache()
    comp = brute_components([(r["doc_id"], r["text"]) for r in told.collect()], 5, 80)[0]
    assert one.columns == docs.columns and {r["doc_id"] for r in one.collect()} == set(comp.values())
    clean = stages[names[2]](spark, one, sf).cache()
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    want = {r[0] for r in brute_contamination([(r["doc_id"], r["text"]) for r in one.collect()], items) if not r[5]}
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == want
    mix = stages[names[3]](spark, clean, sf).cache()
    texts = {r["doc_id"]: (r["source"], r["text"]) for r in clean.collect()}
    got = defaultdict(int)
    for r in mix.collect():                                    # whole documents, up to three times
        assert texts[r["doc_id"]] == (r["source"], r["text"])
        got[r["doc_id"]] += 1
    assert mix.columns == docs.columns and max(got.values()) <= 3
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, (_, t) in texts.items()}
    target = {r["source"]: r["target"] for r in mixing.mix(clean).collect()}
    for source, wanted in target.items():                      # a source misses its target by half of a document at most
        ids = [i for i, (s, _) in texts.items() if s == source]
        assert abs(sum(words[i] * got[i] for i in ids) - wanted) <= max(words[i] for i in ids) / 2 + 1
    last = stages[names[4]](spark, mix, sf)
    texts = [(r["doc_id"], r["text"]) for r in mix.collect()]
    want, at = [], 0
    for i, ids in brute_tokens(texts):
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(tuple(r) for r in last.collect()) == sorted(want)


def test_pipeline_runs_whole(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() > 0
    assert len(corpus_pipeline.STAGES) == 5
