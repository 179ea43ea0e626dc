"""Token ids of documents in ORC files."""

from __future__ import annotations

import json
import os
import string
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm.common import python_batches, running_total, saved, worker_state

END_ID = 2
KNOWN_PIECES = 800_000   # pieces whose ids a worker remembers; further ones are encoded in each batch
JOINED = 200             # pieces that are encoded as one text
AT_ONCE = 50             # texts whose encodings, many times larger than their ids, are held at a time
# White space next to a space or a line feed, or at either end: such texts, and those with the text of a special token,
# are encoded in one go.
WHITE = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
UNEVEN = rf"^{WHITE}|[ \n]{WHITE}|{WHITE}\n|{WHITE}$|\x00"
# Punctuation that ends a word: after a letter it starts a new pre-token. The apostrophe may not.
TAIL = string.punctuation.replace("'", "")
LETTER_END = "[A-Za-zÀ-ÖØ-öø-ÿ]$"
# Integer run-length encoding is ORC's own; the rest of the layout is chosen here.
LAYOUT = {
    "compression": "zstd", "orc.stripe.size": str(64 << 20), "orc.row.index.stride": "1000",
    "orc.create.index": "true", "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
}


class PieceEncoder:
    """Ids of many texts at once with a byte-level tokenizer.

    The tokenizer's pre-tokens never run over a space that a non-space follows, over a single line feed, or from a letter
    into punctuation. So a text is cut there, equal pieces are encoded once per worker (frequent ones) or batch, and
    their occurrences are gathered by numpy.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()                           # texts are encoded beside others, and whole
        self.tokenizer.no_truncation()
        self.cuts = _cut_safely(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: tuple[dict[str, int], dict[str, int]] = ({}, {})     # after a space; elsewhere
        # Entries 0 to 2: nothing, the end of a text, a line feed.
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        # A feed that is one id, and ids that begin with a space (Ġ in byte-level vocabularies), tell pieces apart.
        vocab = self.tokenizer.get_vocab()
        self.feed = feed[0] if len(feed) == 1 else -1
        self.spaced = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.spaced[[i for token, i in vocab.items() if token.startswith("\u0120")]] = True
        self.ids = np.array([end_id, *feed], np.int32)
        self.starts, self.sizes = np.array([0, 0, 1]), np.array([0, 1, len(feed)])

    def _encoded(self, parts: list[str], space: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of non-empty pieces, as one array and a size for each: joined, encoded and cut again where a space or feed is."""
        groups = [parts[at:at + JOINED] for at in range(0, len(parts), JOINED)]
        texts = [" " + " ".join(g) if space else "\n" + "\n".join(g) for g in groups]
        ids = self._ids_of(texts)[0]
        opens = self.spaced[ids] if space else ids == self.feed
        if np.count_nonzero(opens) != len(parts):            # a vocabulary that does not keep them apart
            return self._ids_of([" " + p if space else p for p in parts])
        at = np.flatnonzero(opens)
        if space:
            return ids, np.diff(at, append=len(ids))
        return ids[~opens], np.diff(at, append=len(ids)) - 1

    def _ids_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for at in range(0, len(texts), AT_ONCE):
            own = [e.ids for e in self.tokenizer.encode_batch_fast(texts[at:at + AT_ONCE], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, own), np.int64, len(own)))
            ids.append(np.fromiter(chain.from_iterable(own), np.int32, int(sizes[-1].sum())))
        return np.concatenate(ids), np.concatenate(sizes)

    def _slots(self, pieces: list[str], space: bool) -> np.ndarray:
        """Entry of each of different pieces; pieces not seen yet are encoded, and remembered while there is room."""
        known = self.known[not space]
        slots = np.fromiter(map(known.get, pieces, repeat(-1)), np.int64, len(pieces))
        if "" in pieces:
            slots[pieces.index("")] = 0
        new = np.flatnonzero(slots < 0)
        names = [pieces[i] for i in new]
        ids, sizes = self._encoded(names, space)
        slots[new] = np.arange(len(self.starts), len(self.starts) + len(new))
        self._append(ids, sizes)
        room = max(0, KNOWN_PIECES // 2 - len(known))
        known.update(zip(names[:room], slots[new[:room]].tolist()))
        return slots

    def _append(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and the number of ids of each text."""
        kept = (self.ids, self.starts, self.sizes, [len(k) for k in self.known])
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        uneven = pc.match_substring_regex(texts, UNEVEN if self.cuts else "")
        for token in self.special:
            uneven = pc.or_(uneven, pc.match_substring(texts, token))
        whole = pc.indices_nonzero(uneven).to_numpy().astype(np.int64)
        even = pc.if_else(uneven, pa.scalar("", pa.large_string()), texts)
        cut = pc.split_pattern(pc.replace_substring(even, "\n", " \x00 "), " ")
        first = np.asarray(cut.offsets, dtype=np.int64)
        first -= first[0]
        coded = cut.flatten().dictionary_encode()
        use, words = coded.indices.to_numpy(), coded.dictionary
        cores = pc.utf8_rtrim(words, characters=TAIL)
        cores = pc.if_else(pc.match_substring_regex(cores, LETTER_END), cores, words)
        tailed = pc.indices_nonzero(pc.not_equal(pc.binary_length(words), pc.binary_length(cores)))
        tails = [w[len(c):] for w, c in zip(_strings(words.take(tailed)), _strings(cores.take(tailed)))]
        feed = pc.equal(words, "\x00").to_numpy(zero_copy_only=False)
        fed = feed[use]
        opening = np.zeros(len(use), bool)
        opening[first[:-1]] = True
        opening[1:] |= fed[:-1]
        opening &= ~fed

        # Entries of words by place, after a space and elsewhere: each is its core and its tail.
        slot = np.zeros((2, len(words), 2), np.int64)
        for place, mask in enumerate((~opening & ~fed, opening)):
            wanted = np.flatnonzero(np.bincount(use[mask], minlength=len(words)))
            slot[place, wanted, 0] = self._slots_of(cores.take(pa.array(wanted)), place == 0)
        slot[:, tailed.to_numpy(), 1] = self._slots_of(pa.array(tails, pa.large_string()), False)
        slot[0, feed] = 2, 0
        ids, sizes = self._gathered(slot.ravel())
        sizes = sizes[::2] + sizes[1::2]
        # Further entries are texts that are encoded whole.
        own, own_sizes = self._ids_of(texts.take(pa.array(whole)).to_pylist())
        ids, sizes = np.concatenate([ids, own, self.ids[:1]]), np.concatenate([sizes, own_sizes])
        starts = np.cumsum(sizes) - sizes
        seen = use + opening * np.int64(len(words))
        seen[first[whole]] = 2 * len(words) + np.arange(len(whole))
        # The last piece of a text is one longer, for the end id.
        size = sizes[seen]
        size[first[1:] - 1] += 1
        after = np.cumsum(size)
        out = _ranges(ids, starts[seen], size, after)
        ends = after[first[1:] - 1]
        out[ends - 1] = self.ids[0]
        if [len(k) for k in self.known] == kept[3]:           # nothing of this batch is remembered
            self.ids, self.starts, self.sizes = kept[:3]
        return out, np.diff(ends, prepend=0)

    def _gathered(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.sizes[entries]
        return _ranges(self.ids, self.starts[entries], size, np.cumsum(size)), size

    def _slots_of(self, pieces: pa.Array, space: bool) -> np.ndarray:
        coded = pieces.dictionary_encode()
        return self._slots(_strings(coded.dictionary), space)[coded.indices.to_numpy()]


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


def _ranges(ids: np.ndarray, starts: np.ndarray, size: np.ndarray, after: np.ndarray) -> np.ndarray:
    """``size`` ids from each of ``starts`` on, one range behind the other; ``after`` sums up the sizes."""
    at = np.repeat(starts - (after - size), size)
    at += np.arange(len(at))
    return ids[at]


def _cut_safely(path: str) -> bool:
    """Whether texts may be cut at the places above: pre-tokens of byte-level BPE, as they are. Else texts are encoded whole."""
    with open(path, encoding="utf-8") as file:
        kind = json.load(file)
    split = kind.get("pre_tokenizer") or {}
    return (kind.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex", True)
            and not split.get("add_prefix_space") and kind.get("model", {}).get("type") == "BPE")


def worker_encoder(path: str, end_id: int) -> PieceEncoder:
    """One encoder per worker process, so that tasks that follow each other share what it remembers."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"        # a task has one core
    return worker_state(f"token_files {path} {end_id}", lambda: PieceEncoder(path, end_id))


def write_token_files(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = END_ID) -> None:
    """Encode every document and write ``doc_id, n_tokens, ids`` as ORC in ascending doc_id order.

    Files hold consecutive id ranges and are sorted inside, so stripe statistics, row indexes and Bloom filters on
    doc_id prune reads, and every stripe can be read by a task of its own. Texts, not ids, are shuffled. Null texts
    are empty (the end id alone), null ids come first, repeated rows are written as often as they come, other columns
    are ignored, an empty table writes no rows.
    """
    python_batches(docs.sparkSession, 1000, "4m")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_file, end_id)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, sizes = encoder.encode(batch.column(1))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes.astype(np.int64)), lists],
                                             ["doc_id", "n_tokens", "ids"])
            pa.default_memory_pool().release_unused()     # the worker lives on beside others

    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(encode, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids array<int>") \
        .write.options(**LAYOUT).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows; filters on doc_id reach stripes and row groups."""
    spark.conf.set("spark.sql.orc.columnarReaderBatchSize", 512)
    return spark.read.orc(path)


def token_index(tokens: DataFrame) -> DataFrame:
    """Per row of token files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    python_batches(tokens.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            raw = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
            sums = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())],
                ["doc_id", "n_tokens", "ids_crc32"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    rows = tokens.select("doc_id", "ids").mapInArrow(digest, f"doc_id {kind}, n_tokens long, ids_crc32 long")
    rows = saved(rows, "token_rows")
    return running_total(rows, ["doc_id", "n_tokens", "ids_crc32"], "n_tokens", "start").select(
        "doc_id", "start", "n_tokens", "ids_crc32")
