"""Toxicity scores of restored text: a noisy-channel decoder undoes leetspeak, spacing and repetition first."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import fold, labelled_sample, python_batches, saved

# Letters that a symbol may stand for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
MONEY = "@$€£"           # seldom punctuation
# Log costs of the channel: a symbol for a letter, a stray symbol, a repeated letter.
SWAP, STRAY, REPEAT = -1.0, -2.0, -0.7
# White space in a run of short tokens, by whether both neighbours are single letters: dropped, or kept as a word end.
DROP, KEEP = {True: 0.0, False: -1.5}, {True: -1.0, False: 0.0}
INSERT = -3.0            # a word end where there is no white space
KNOWN = 4.0              # gain of a word that has evidence of its own, in runs
KNOWN_TOKEN = 10.0       # and in a token of letters and symbols, where no white space is in doubt
CLASSES = 28             # boundary, a to z, any other letter
SAMPLE_DOCS = 10_000     # bound of the labelled rows that the classifier is fitted on
KEPT_TOKENS = 300_000    # tokens whose evidence a worker remembers
PREFIXES = (5, 6, 7, 8)   # shorter beginnings are shared with ordinary words
LEAST_DOCS, LEAST_LIFT, LEAST_G2 = 5, 2.5, 30.0
SPACED = re.compile(r"(?<!\S)(?:\S[^\S\n]){2,}\S(?!\S)")
SHORT_RUN = re.compile(r"(?<!\S)\S{1,4}(?:\s+\S{1,4})+(?!\S)")
# Letters as the screen of runs sees them: symbols as letters, i and l as one, nothing else.
SCREEN = {**{chr(c): None for c in range(128) if not chr(c).isalpha()}, **{k: v[0] for k, v in LEET.items()}, "l": "i", "£": "i"}
SCREEN = str.maketrans(SCREEN)
REPEATED = re.compile(r"([^\W\d_])\1\1")

_TABLE = np.zeros(256, np.int64)
_TABLE[97:123] = _TABLE[65:91] = np.arange(1, 27)
_TABLE[128:] = 27


def letter_class(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c.isalpha() else 0


def character_model(docs: DataFrame) -> np.ndarray:
    """Trigram log probabilities of letters over the texts of all rows.

    Each task sums one table of 28 x 28 x 28 counts for what it reads; the sums meet in a shuffle by cell.
    """
    python_batches(docs.sparkSession)
    cells = CLASSES ** 3

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, np.int64)
        for batch in batches:
            text = batch.column(0).cast(pa.binary())
            offsets, data = np.frombuffer(text.buffers()[1], np.int32)[text.offset:], text.buffers()[2]
            if data is None or not len(text):
                continue
            x = _TABLE[np.frombuffer(data, np.uint8)[offsets[0]:offsets[len(text)]]]
            if len(x) > 2:
                total += np.bincount(x[:-2] * CLASSES ** 2 + x[1:-1] * CLASSES + x[2:], minlength=cells)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["cell", "n"])

    rows = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(count, "cell long, n long")
    rows = rows.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()      # 21,952 rows at most
    counts = np.full(cells, 0.1)
    counts[rows["cell"].to_numpy(np.int64)] += rows["n"].to_numpy(np.float64)
    counts = counts.reshape(CLASSES, CLASSES, CLASSES)
    return np.log(counts / counts.sum(axis=2, keepdims=True))


def _options(symbol: str, times: int, edge: bool) -> list[tuple[str, float]]:
    """What a run of one symbol may have been, with log costs; the edges of a token shed symbols freely."""
    if symbol.isalpha():
        kept = [(symbol * min(times, 2), 0.0 if times < 3 else REPEAT)]
        return kept + ([(symbol, REPEAT)] if times > 1 else [])
    out = [("", STRAY / 4 if edge else STRAY)]
    for letter in LEET.get(symbol, ""):
        out.append((letter, SWAP + (REPEAT if times > 1 else 0)))
        if times > 1:
            out.append((letter * 2, SWAP + REPEAT))
    return out


def decode(token: str, model: np.ndarray, shed: bool = True) -> str:
    """The likeliest plain word behind a token: Viterbi over its character lattice under the trigram model.

    Symbols at the edges are punctuation rather than letters, unless ``shed`` is off.
    """
    runs = [(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", token, re.S)]
    paths = {(0, 0): (0.0, "")}
    for k, (symbol, times) in enumerate(runs):
        after: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, text) in paths.items():
            edge = shed and (k == len(runs) - 1 or k == 0 and not symbol.isdigit())     # a leading digit is a letter
            for letters, cost in _options(symbol, times, edge):
                x, y, s = a, b, score + cost
                for c in letters:
                    z = letter_class(c)
                    s += model[x, y, z]
                    x, y = y, z
                if (x, y) not in after or s > after[x, y][0]:
                    after[x, y] = (s, text + letters)
        paths = after
    return max(((s + model[a, b, 0], t) for (a, b), (s, t) in paths.items()), default=(0, ""))[1]


def decode_run(run: str, model: np.ndarray, known: dict[str, bool] | None = None, gain: float = KNOWN) -> list[str]:
    """The likeliest words behind a run of short tokens.

    Viterbi over the characters of the whole run. White space is dropped or kept as a word end, and a word end may be
    inserted; the trigram model decides, with a gain for ``known`` words. ``known`` maps these words (True) and their
    beginnings (False); a path's state is its last two letters and the beginning that it stands in.
    """
    known = known or {}
    tokens = run.split()
    # Per state: score and words so far, as links back.
    paths: dict[tuple, tuple] = {(0, 0, ""): (0.0, None)}

    def step(after: dict, state: tuple, score: float, link, letters: str) -> None:
        a, b, word = state
        for c in letters:
            z = letter_class(c)
            score += model[a, b, z]
            a, b = b, z
            word = word + c if word is not None and word + c in known else None
        if (a, b, word) not in after or score > after[a, b, word][0]:
            after[a, b, word] = (score, (link, letters) if letters else link)

    def ended(state: tuple, score: float, link) -> tuple:
        a, b, word = state
        return (b, 0, ""), score + model[a, b, 0] + (gain if word and known[word] else 0.0), (link, " ")

    for n, token in enumerate(tokens):
        if n:
            single = len(token) == 1 == len(tokens[n - 1])
            after: dict[tuple, tuple] = {}
            for state, (score, link) in paths.items():
                step(after, state, score + DROP[single], link, "")
                to, s, e = ended(state, score + KEEP[single], link)
                step(after, to, s, e, "")
            paths = after
        runs = [(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", token, re.S)]
        for k, (symbol, times) in enumerate(runs):
            after = {}
            options = _options(symbol, times, len(runs) > 1 and k in (0, len(runs) - 1))
            if n and not k and single and token == tokens[n - 1]:
                options.append(("", REPEAT))
            for state, (score, link) in paths.items():
                starts = [(state, score, link)]
                if k and state[1]:
                    starts.append(ended(state, score + INSERT, link))
                for letters, cost in options:
                    for at, s, e in starts:
                        step(after, at, s + cost, e, letters)
            paths = after
    score, link = max((ended(state, s, e)[1:] for state, (s, e) in paths.items()), key=lambda x: x[0])
    out = []
    while link:
        link, piece = link
        out.append(piece)
    return "".join(reversed(out)).split()


def screened(text: str) -> str:
    return re.sub(r"(.)\1+", r"\1", "".join(text.translate(SCREEN).split()))


def restored(token: str, model: np.ndarray) -> list[str]:
    """Words that a lower-case token may stand for; plain tokens stand for themselves."""
    plain = token.strip("".join(c for c in set(token) if not c.isalnum())) if not token.isalpha() else token
    out = [plain] if plain.isalpha() else [w for w in re.split(r"[\W_]+", plain) if w.isalpha() and len(w) > 1]
    symbols = sum(not c.isalpha() for c in token)
    leet = any(c in LEET for c in token) and (symbols < len(token) or sum(c in MONEY for c in token) > 1)
    if leet or REPEATED.search(token) or (len(plain) > 4 and re.fullmatch(r"\w(?:[\W_]\w)+", plain)):
        as_letters = not plain.isalpha() or token[0] in MONEY or token[-1] in MONEY
        for word in (decode(token, model), decode(token, model, shed=False) if as_letters else ""):
            if word and word not in out:
                out.append(word)
    return out


def spaced_out(text: str) -> list[str]:
    """Letters set apart by single spaces, joined."""
    return [re.sub(r"\s", "", m) for m in SPACED.findall(text)]


def features(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in PREFIXES if n < len(word))]


@dataclass
class ToxicityModel:
    characters: np.ndarray
    evidence: dict[str, float]
    base: float
    slope: float = 1.0

    def __post_init__(self):
        """Words with evidence and their beginnings, and a screen for runs in which one of them may stand."""
        words = [f for f in self.evidence if not f.endswith("*") and len(f) > 2]
        self.known = {w[:n]: False for w in words for n in range(len(w) + 1)} | dict.fromkeys(words, True)
        self.screen = re.compile("|".join(map(re.escape, sorted({screened(w) for w in words} - {""})))) if words else None

    def of_runs(self, text: str) -> dict[str, float]:
        """Evidence that shows when white space inside of words is undone, in lower-case text."""
        found: dict[str, float] = {}
        for m in SHORT_RUN.finditer(text) if self.screen else ():
            if self.screen.search(screened(m[0])):
                for word in decode_run(m[0], self.characters, self.known):
                    if (v := self.evidence.get(word)) is not None:
                        found[word] = v
        return found

    def probability(self, found: dict[str, float]) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.base + self.slope * sum(found.values())))))

    def of_token(self, token: str) -> dict[str, float]:
        """The strongest feature of each restored word; known words gain where symbols may spell one."""
        best: dict[str, float] = {}
        words = restored(token, self.characters)
        mixed = not token.isalpha() and any(c in LEET for c in token) and any(c.isalpha() for c in token)
        if mixed and self.screen and self.screen.search(screened(token)):
            words += [w for w in decode_run(token, self.characters, self.known, KNOWN_TOKEN) if w not in words]
        for word in words:
            found = [(v, f) for f in features(word) if (v := self.evidence.get(f)) is not None]
            if found:
                v, f = max(found)
                best[f] = v
        return best


def tokens_of(text: str) -> set[str]:
    text = text.lower()
    return set(text.split()).union(spaced_out(text))


def labels_for(labels: DataFrame, sample: int = SAMPLE_DOCS, seed: int = 13) -> DataFrame:
    """doc_id and toxic of about ``sample`` labelled ids at most; repeated ids are toxic if one row says so."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
    known = saved(known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")), "labels")
    return labelled_sample(known, "doc_id", sample, seed)


def fit(labelled: DataFrame, characters: np.ndarray) -> ToxicityModel:
    """Evidence of words and word beginnings, from a bounded sample of rows with doc_id, text and toxic.

    Equal texts count once. A feature is kept when it stands in ``LEAST_DOCS`` toxic texts, its log-likelihood ratio is
    ``LEAST_LIFT`` and the G-squared statistic ``LEAST_G2`` or more. Counts are filtered by Spark before they come to
    the driver: what is kept is bounded by the sample.
    """
    rows = labelled.where(F.col("text").isNotNull()).groupBy(F.xxhash64("text").alias("h")).agg(
        F.min_by("text", "doc_id").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")
    rows = saved(rows, "labelled_texts")
    shared = labelled.sparkSession.sparkContext.broadcast(characters)
    python_batches(labelled.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        for batch in batches:
            counts = Counter()
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = {""}
                for t in tokens_of(text):
                    if t not in known:
                        if len(known) > KEPT_TOKENS:
                            known.clear()
                        known[t] = [f for w in restored(t, shared.value) for f in features(w)]
                    found.update(known[t])
                counts.update((f, toxic) for f in found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.int32()),
                 pa.array(list(counts.values()), pa.int64())], ["feature", "toxic", "n"])

    counts = rows.mapInArrow(count, "feature string, toxic int, n long")
    counts = counts.groupBy("feature").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum("n").alias("n"))
    kept = counts.where((F.col("feature") == "") | (F.col("bad") >= LEAST_DOCS) & (4 * F.col("bad") >= F.col("n"))).collect()
    total = next((r for r in kept if r["feature"] == ""), None)
    if total is None or not total["bad"] or total["bad"] == total["n"]:
        rate = 0.0 if total is None else total["bad"] / total["n"]
        return ToxicityModel(characters, {}, math.log((rate + 0.01) / (1.01 - rate)))
    t, c = total["bad"], total["n"] - total["bad"]
    evidence = {}
    for r in kept:
        a, b = r["bad"], r["n"] - r["bad"]
        lift = math.log((a + 0.5) / (t + 1)) - math.log((b + 0.5) / (c + 1))
        share = (a + b) / (t + c)
        g2 = 2 * sum(x * math.log(x / e) for x, e in ((a, t * share), (b, c * share)) if x)
        if r["feature"] and lift >= LEAST_LIFT and g2 >= LEAST_G2:
            evidence[r["feature"]] = lift
    # A beginning that stands for one much longer word says nothing of other words.
    found = {r["feature"]: r["bad"] for r in kept}
    for word in [f for f in evidence if not f.endswith("*")]:
        for n in range(PREFIXES[0], len(word) - 2):
            if found[word] >= 0.9 * found.get(word[:n] + "*", math.inf):
                evidence.pop(word[:n] + "*", None)
    model = ToxicityModel(characters, evidence, 0.0)      # with the words known, runs of short tokens can be decoded
    sums = weigh(rows, model, ["toxic"], lambda m, found: sum(found.values()), "evidence").toPandas()
    model.base, model.slope = calibrated(sums["evidence"].to_numpy(np.float64), sums["toxic"].to_numpy(np.float64))
    return model


def calibrated(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, float]:
    """Intercept and slope of a ridge logistic regression on one variable, by Newton's method."""
    a = np.column_stack([np.ones_like(x), x])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge * np.eye(2), a.T @ (y - p) - ridge * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def score(docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """Columns of ``keep`` and ``score`` (0 to 1) of every row, from its whole restored text; null texts are empty."""
    return weigh(docs, model, keep, ToxicityModel.probability, "score")


def weigh(docs: DataFrame, model: ToxicityModel, keep: list[str], number, name: str) -> DataFrame:
    """``number`` of the model and the features that a text holds, for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    python_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known: dict[str, dict[str, float] | None] = {}

        def one(text: str | None) -> float:
            found: dict[str, float] = {}
            for t in tokens_of(text) if text else ():
                if t in known:
                    e = known[t]
                else:
                    if len(known) > KEPT_TOKENS:
                        known.clear()
                    e = known[t] = model.of_token(t) or None
                if e:
                    found.update(e)
            found.update(model.of_runs(text.lower()) if text else ())
            return float(number(model, found))

        for batch in batches:
            numbers = pa.array([one(t) for t in batch.column(batch.num_columns - 1).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], numbers], [*keep, name])

    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep) + f", {name} double"
    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, *, folds: int = 4, held_out: int = 2, cut: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row.

    The character model reads the texts of all rows. The classifier learns from labelled rows that are not held out;
    labels, lang, source and ids are never inputs. Repeated ids in ``labels`` count as toxic if one of them is; an empty
    table gives an empty result; without usable labels every text gets the base rate. Null texts are empty and get the
    score of a text without evidence; null ids fall in fold 0; whole texts are read, however long; repeated rows are
    scored each, alike; other columns, named like results or not, are ignored.
    """
    mark = fold(F.col("doc_id"), folds) == held_out
    marks = labels_for(labels.select("doc_id", "toxic").where(~mark))
    # The sample is bounded by SAMPLE_DOCS, so it can go to every task; the texts stay where they are.
    train = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")
    model = fit(train, character_model(docs))
    scored = score(docs.select("doc_id", mark.alias("held_out"), "text"), model, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))
