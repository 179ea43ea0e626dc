"""Secrets in texts: fixed patterns, and strings that a Markov model of random characters explains better."""

from __future__ import annotations

import hashlib
import importlib
import random
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.common import labelled_sample, python_batches

# Fixed values of the contract: kinds in the order of their listing, with pattern, group and least length.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]{32,}"), 0, 32),      # of runs of any length, those that are kept
)
KINDS = ("assign", "access", "hex", "markov")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
UUID = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Fa-f])")   # random, but no key
KEYWORDS = ("passw", "secret", "token", "api")
# Other alphabets that keys are drawn from: hex in both cases, base 32, base 36, base 62, base 64.
DRAWN = ("0123456789abcdef", "0123456789ABCDEF", ALPHABET[:26] + "234567", "0123456789" + ALPHABET[26:52],
         ALPHABET[:62], ALPHABET[:64])
SAMPLE_DOCS = 6000       # bound of the rows that the models are trained on
LEAST_RATIO = 12.0       # log-likelihood ratio of a secret, summed over its characters
# Modules of the standard library and Spark whose names are samples of ordinary identifiers.
NAMED_IN = (
    "argparse", "ast", "asyncio", "base64", "builtins", "calendar", "collections", "concurrent.futures", "configparser",
    "contextlib", "csv", "datetime", "decimal", "difflib", "email.message", "errno", "fractions", "functools", "gzip",
    "hashlib", "html.parser", "http.client", "http.cookies", "imaplib", "inspect", "io", "ipaddress", "itertools", "json",
    "logging.handlers", "mailbox", "mimetypes", "multiprocessing", "operator", "optparse", "os", "pathlib", "platform",
    "queue", "random", "selectors", "shutil", "smtplib", "socket", "statistics", "string", "struct", "subprocess", "tarfile",
    "tempfile", "textwrap", "threading", "time", "tokenize", "traceback", "typing", "unittest.mock", "urllib.request", "uuid",
    "warnings", "weakref", "xml.dom.minidom", "xmlrpc.client", "zipfile", "pyspark.sql.functions", "pyspark.sql.types",
    "pyspark.ml.classification",
)

_CODE = np.full(256, 67, np.int64)
_CODE[[ord(c) for c in ALPHABET]] = np.arange(67)
STATES = 68              # 67 characters, and one for the edge of a string


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the fixed patterns, by start and then kind."""
    out = []
    low = text.lower()
    for k, (_, pattern, group, least) in enumerate(BASE):
        if k == 0 and not any(w in low for w in KEYWORDS):
            continue
        out += [(m.start(), m.end(), k) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return sorted(out, key=lambda s: (s[0], s[2]))


def steps(string: str) -> np.ndarray:
    codes = _CODE[np.frombuffer(string.encode("ascii", "replace"), np.uint8)]
    return np.concatenate([[67], codes]) * STATES + np.concatenate([codes, [67]])


def drawn_strings(seed: int, each: int = 400) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(a, k=rng.randint(20, 48))) for a in DRAWN for _ in range(each)]


def library_names() -> list[str]:
    """Names that programmers gave: of the modules in ``NAMED_IN``, their members and those of their classes."""
    names = set(sys.stdlib_module_names)
    for module in map(importlib.import_module, NAMED_IN):
        for name in dir(module):
            names.add(name)
            if isinstance(member := getattr(module, name, None), type):
                names.update(dir(member))
    return sorted({n.strip("_") for n in names} - {""})


def ordinary_strings(seed: int, each: int = 3000) -> list[str]:
    """Ordinary identifiers by their usual shapes: camel and snake case, paths, versions, dates, numbers and stamps."""
    rng, names = random.Random(seed), library_names()
    words = sorted({w.lower() for n in names for w in re.findall(r"[A-Z]?[a-z]{2,}|[A-Z]{2,}", n)})
    number = lambda low, high: str(rng.randrange(10 ** low, 10 ** high))                       # noqa: E731
    out = names
    for _ in range(each):
        some = rng.choices(words, k=rng.randint(2, 6))
        tail = rng.choice(["", number(0, 1), number(1, 2), "_v" + number(0, 1)])
        day = (rng.randint(1950, 2040), rng.randint(1, 12), rng.randint(1, 28))
        out += [
            "".join(w.capitalize() for w in some) + tail, some[0] + "".join(w.capitalize() for w in some[1:]) + tail,
            *(mark.join(some) + tail for mark in "_-/"), "_".join(some).upper() + tail, "/" + "/".join(some) + tail,
            number(0, rng.randint(1, 14)), "{}-{:02}-{:02}".format(*day), "{}-{}{:02}{:02}-".format(some[0], *day) + number(3, 6),
            f"{some[0]}-{number(0, 1)}-{number(0, 2)}-{number(0, 2)}", some[0].upper() + "-" + number(0, 5),
            some[0].capitalize() + some[1].upper(),
        ]
    return out


def counted(strings: list[str]) -> np.ndarray:
    return sum((np.bincount(np.concatenate([steps(s) for s in strings[k:k + 5000]]), minlength=STATES * STATES)
                for k in range(0, len(strings), 5000)), np.zeros(STATES * STATES))


def train(docs: DataFrame, *, sample: int = SAMPLE_DOCS, seed: int = 17) -> np.ndarray:
    """Log-likelihood ratio of each character step: random strings against ordinary identifiers.

    Labels come from the texts: values that a fixed pattern finds are secrets, words and identifiers outside of such
    spans are ordinary. At most about ``sample`` rows are read. Tasks count steps and a shuffle sums them. As texts may
    hold one alphabet and prose only, strings drawn by a seeded rule from the usual key alphabets join the secrets, and
    identifiers of the usual shapes the ordinary strings; neither side outweighs what the texts hold, nor the reverse.
    """
    python_batches(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, STATES * STATES), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                spans, at, rest = base_spans(text), 0, []
                for start, end, kind in spans:
                    value = BASE[kind][1].match(text, start)
                    total[0] += np.bincount(steps(value[BASE[kind][2]]), minlength=STATES * STATES) if value else 0
                    rest.append(text[at:start])
                    at = max(at, end)
                ordinary = re.findall(r"[A-Za-z0-9+/_=-]{3,}", " ".join([*rest, text[at:]]))
                if ordinary:
                    total[1] += np.bincount(np.concatenate([steps(w) for w in ordinary]), minlength=STATES * STATES)
        label, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(cell), pa.array(total[label, cell])], ["label", "cell", "n"])

    rows = labelled_sample(docs.where(F.col("text").isNotNull()), "text", sample, seed).select("text")
    rows = rows.mapInArrow(count, "label long, cell long, n long").groupBy("label", "cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros((2, STATES * STATES))
    counts[rows["label"].to_numpy(np.int64), rows["cell"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    # Both sources of a class weigh the same at most, whatever the texts hold.
    odds = []
    for own, made in zip(counts, (counted(drawn_strings(seed)), counted(ordinary_strings(seed)))):
        c = (made + own * min(1.0, made.sum() / max(1.0, own.sum()))).reshape(STATES, STATES) + 0.5
        odds.append(np.log(c / c.sum(axis=1, keepdims=True)))
    return (odds[0] - odds[1]).ravel()


def model_spans(text: str, ratio: np.ndarray, least: float) -> list[tuple[int, int, int]]:
    """Parts of runs of key characters whose summed ratio is ``least`` or more, widened to the piece they stand in.

    A running maximum finds the best part of every run at once: sums start anew after other characters. Parts of one
    run are found from the best one outwards. UUIDs are ordinary.
    """
    if "-" in text:
        text = UUID.sub(lambda m: " " * len(m[0]), text)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    code = _CODE[np.minimum(code, 255)]
    before = np.concatenate([[67], code[:-1]])[:len(code)]
    gain = np.where(code == 67, APART, ratio[before * STATES + code])
    sums = np.concatenate([[0.0], np.cumsum(gain)])
    hits = np.flatnonzero(sums - np.minimum.accumulate(sums) >= least) - 1
    out: list[tuple[int, int, int]] = []
    edges = np.flatnonzero(np.concatenate([[True], code == 67, [True]])) - 1          # other characters, and both ends
    for place in np.unique(np.searchsorted(edges, hits, "right")):
        parts = [(int(edges[place - 1]) + 1, int(edges[place]))]
        while parts:
            a, z = parts.pop()
            part = np.concatenate([[0.0], np.cumsum(gain[a:z])])
            low = np.minimum.accumulate(part)
            end = int(np.argmax(part - low))
            if part[end] - low[end] < least:
                continue
            start, end = a + int(np.flatnonzero(part[:end + 1] == low[end])[-1]), a + end
            while text[start] in "/_-=" and start < end - 1:
                start += 1
            while text[end - 1] in "/_-" and end - 1 > start:
                end -= 1
            while start > a and text[start - 1] not in "/_-=":
                start -= 1
            while end < z and text[end] not in "/_-":
                end += 1
            out.append((start, end, 3))
            parts += [(a, start), (end, z)]
    return sorted(out)


APART = -1000.0          # no part runs over a character that keys do not have


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def scan(docs: DataFrame, *, sample: int = SAMPLE_DOCS, least: float = LEAST_RATIO) -> DataFrame:
    """Secret spans of every whole text: doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans.

    Spans of the fixed patterns always stay. A part of a run of key characters, outside of those spans, is added when
    its log-likelihood ratio, summed over its characters, is ``least`` or more. Null texts are empty; repeated rows
    get equal results; an empty table gives an empty result; other columns are ignored. Nothing is grouped by text or
    source, so no group can grow.
    """
    ratio = docs.sparkSession.sparkContext.broadcast(train(docs, sample=sample))
    python_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = [], [], []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                more = [s for s in model_spans(text or "", ratio.value, least)
                        if not any(a < s[1] and s[0] < b for a, b, _ in base)]
                counts.append([sum(k == n for _, _, k in base) for n in range(3)] + [len(more)])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(sorted([*base, *more], key=lambda s: (s[0], s[2]))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([c[n] for c in counts], pa.int64()) for n in range(4)),
                 pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_markov", "base_sha256", "spans"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string")
