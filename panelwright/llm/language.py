"""Language identification: known words first, then ever shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from panelwright.llm.common import fold, labelled_sample, python_batches, saved, worker_state

WORD = re.compile(r"[^\W\d_]+")
LONGEST = 5              # characters of the longest n-gram
SAMPLE_DOCS = 6000       # bound of the labelled rows that the model is fitted on
MODEL_ENTRIES = 400_000  # bound of the model's words and n-grams: the most frequent ones
KEPT_TOKENS = 300_000    # tokens whose scores a worker remembers
UNKNOWN = "und"


@dataclass
class LanguageModel:
    """Log frequencies by language; rows of ``table`` are known words and n-grams, columns ``langs``."""

    langs: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    table: np.ndarray

    def scores(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of each token: the sum of its words' scores, and the number of its words.

        A known word has its own scores, another one the mean of its longest known n-grams, zero if nothing is known.
        All rows wanted are gathered from the table at once.
        """
        rows: list[int] = []
        sizes, owners, words = [], [], np.zeros(len(tokens), np.int32)
        known, grams = self.words, self.grams
        for at, token in enumerate(tokens):
            found = (token,) if token.isascii() and token.isalpha() else words_of(token)
            words[at] = len(found)
            for word in found:
                row = known.get(word)
                if row is not None:
                    rows.append(row)
                    sizes.append(1)
                    owners.append(at)
                    continue
                padded = f"^{word}$"
                for n in range(min(LONGEST, len(padded)), 0, -1):
                    got = [r for i in range(len(padded) - n + 1) if (r := grams.get(padded[i:i + n])) is not None]
                    if got:
                        rows += got
                        sizes.append(len(got))
                        owners.append(at)
                        break
        out = np.zeros((len(tokens), len(self.langs)), np.float32)
        if rows:
            size = np.array(sizes)
            own, share = np.repeat(np.array(owners), size), np.repeat(1 / size, size)
            picked = self.table[np.array(rows)]
            for k in range(len(self.langs)):
                out[:, k] = np.bincount(own, picked[:, k] * share, len(tokens))
        return out, words


def words_of(text: str) -> list[str]:
    return [w for w in WORD.findall(text.lower()) if w.isalpha() or any(c.isalpha() for c in w)]


def fit(docs: DataFrame, *, sample: int = SAMPLE_DOCS, seed: int = 11) -> LanguageModel:
    """Fit on rows with text and lang, at most about ``sample`` of them, drawn by a hash of doc_id.

    Words and their n-grams are counted by tasks and shuffles; at most ``MODEL_ENTRIES`` of them come to the driver.
    """
    rows = labelled_sample(docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()), "doc_id", sample, seed)
    python_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("language")
        for batch in batches:
            counts: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[lang].update(words_of(text))
            flat = [(lang, w, n) for lang, c in counts.items() for w, n in c.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in flat], t) for k, t in enumerate((pa.string(), pa.string(), pa.int64()))],
                ["lang", "word", "n"])

    counts = rows.select("lang", "text").mapInArrow(count, "lang string, word string, n long")
    return model_of(counts.groupBy("lang", "word").agg(F.sum("n").alias("n")))


def model_of(counts: DataFrame) -> LanguageModel:
    """The model of (lang, word, n) rows. An entry has its ``size``: 0 for a whole word, else the characters of an n-gram."""
    padded = F.concat(F.lit("^"), "word", F.lit("$"))
    cut = lambda n: F.transform(                                                      # noqa: E731
        F.sequence(F.lit(1), F.length(padded) - n + 1), lambda i: F.struct(n.alias("size"), padded.substr(i, n).alias("entry")))
    every = F.flatten(F.transform(F.sequence(F.lit(1), F.least(F.lit(LONGEST), F.length(padded))), cut))
    whole = F.array(F.struct(F.lit(0).alias("size"), F.col("word").alias("entry")))
    counts = saved(counts, "language_words")
    names = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    entries = counts.select("lang", "n", F.explode(F.concat(whole, every)).alias("e"))
    by_lang = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).alias(f"n{k}") for k, lang in enumerate(names)]
    entries = entries.groupBy(F.col("e.size").alias("size"), F.col("e.entry").alias("entry")).agg(F.sum("n").alias("total"), *by_lang)
    entries = saved(entries, "language_entries")
    # Seen once in all: an n-gram or word of no use, left to the shorter ones, unless all of its size are so.
    sizes = [r["size"] for r in entries.groupBy("size").agg(F.max("total").alias("most")).where("most >= 2").collect()]
    kept = entries.where((F.col("total") >= 2) | ~F.col("size").isin(sizes))
    if kept.count() > MODEL_ENTRIES:
        kept = kept.orderBy(F.desc("total"), "size", "entry").limit(MODEL_ENTRIES)
    kept = kept.toArrow()
    table = np.array([kept[f"n{k}"].to_numpy() for k in range(len(names))], np.float64).reshape(len(names), kept.num_rows).T
    size, entry = kept["size"].to_numpy(), kept["entry"].to_pylist()
    for k in np.unique(size):
        part = table[size == k]
        table[size == k] = np.log((part + 0.5) / (part.sum(axis=0) + 0.5 * len(part)))
    known = {e: r for r, (e, k) in enumerate(zip(entry, size)) if k == 0}
    grams = {e: r for r, (e, k) in enumerate(zip(entry, size)) if k}
    return LanguageModel(names, known, grams, table.astype(np.float32))


def predict(docs: DataFrame, model: LanguageModel, keep: list[str] | None = None) -> DataFrame:
    """``lang_pred`` and ``score`` of every row beside its columns (or those of ``keep``); only the text is looked at.

    ``score`` is the tempered posterior of the predicted language. Texts that are null or have no letter, and all
    texts under a model without languages, get ``und`` and 0. Other columns, equal names included, are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    python_batches(docs.sparkSession)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("language")
        model = shared.value
        size = len(model.langs)
        seen: dict[str, int] = {}
        rows, words = np.zeros((KEPT_TOKENS, size), np.float32), np.zeros(KEPT_TOKENS, np.int32)

        def learn(part: list[tuple[int, list[str], np.ndarray]]) -> None:
            new = list(set().union(*(tokens for _, tokens, _ in part)).difference(seen))
            if len(seen) + len(new) > KEPT_TOKENS:
                seen.clear()
                new = list(set().union(*(tokens for _, tokens, _ in part)))
            at = len(seen)
            rows[at:at + len(new)], words[at:at + len(new)] = model.scores(new)
            seen.update(zip(new, range(at, at + len(new))))

        def parts(texts: list[str | None]) -> Iterator[list[tuple[int, list[str], np.ndarray]]]:
            """(text, tokens, times) of up to half of the tokens that are remembered; a long text comes in pieces."""
            part, held = [], 0
            for k, text in enumerate(texts):
                counts = Counter(text.lower().split()) if text and size else {}
                tokens, times = list(counts), np.fromiter(counts.values(), np.float64, len(counts))
                for a in range(0, len(tokens), KEPT_TOKENS // 4):
                    piece = tokens[a:a + KEPT_TOKENS // 4]
                    part.append((k, piece, times[a:a + len(piece)]))
                    held += len(piece)
                    if held >= KEPT_TOKENS // 4:
                        yield part
                        part, held = [], 0
            yield part

        def told(texts: list[str | None]) -> Iterator[tuple[str, float]]:
            total, n = np.zeros((len(texts), size)), np.zeros(len(texts), np.int64)
            for part in parts(texts):
                learn(part)
                for k, tokens, times in part:
                    at = [seen[t] for t in tokens]
                    total[k] += times @ rows[at]
                    n[k] += int(times @ words[at])
            for sums, count in zip(total, n):
                if not count:
                    yield UNKNOWN, 0.0
                    continue
                odds = np.exp((sums - sums.max()) / np.sqrt(count))
                best = int(sums.argmax())
                yield model.langs[best], float(odds[best] / odds.sum())

        for batch in batches:
            got = list(told(batch.column(batch.num_columns - 1).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                [*kept, "lang_pred", "score"])

    schema = StructType([*docs.select(*kept).schema.fields, StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])
    return docs.select(*kept, F.col("text").alias("__text")).mapInArrow(score, schema)


def identify(docs: DataFrame, *, folds: int = 3, held_out: int = 1, sample: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row, by a model of the rows that are not held out.

    Null texts and texts without a letter get ``und`` and 0; so do all if no row with text and lang can be learned from.
    Languages that score the same go by the first of their names. Null ids fall in fold 0; rows that repeat are scored
    each, alike; whole texts count, however long, in pieces if need be. An empty table gives an empty result; other
    columns are ignored.
    """
    mark = fold(F.col("doc_id"), folds) == held_out
    model = fit(docs.where(~mark), sample=sample)
    return predict(docs.select("doc_id", mark.alias("held_out"), "text"), model, ["doc_id", "held_out"])


def identified(docs: DataFrame, *, least: float = 0.4, folds: int = 3, held_out: int = 1) -> DataFrame:
    """Documents whose language is told: those without a letter, or with a score under ``least``, go."""
    model = fit(docs.where(fold(F.col("doc_id"), folds) != held_out))
    told = predict(docs, model)
    return told.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(*docs.columns)
