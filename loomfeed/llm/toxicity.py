"""Toxicity score from a weighted lexicon found by an Aho-Corasick automaton.

Texts are folded first: lower case, look-alike letters and digit substitutions
to plain letters, everything else to a blank. The lexicon is mined from labelled
rows: words and word beginnings that are much more frequent in toxic texts get
their log odds as weight. Neighbouring words that make an entry harmless become
exception phrases, whose match takes back the weight. The found weight, also
divided by the length of the text, feeds a logistic calibration.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomfeed.llm.common import batch_of, map_arrow, raw_texts, store, with_fields, without

#: Labelled rows the lexicon is mined from, at most; by hash of the key.
MAX_ROWS = 20_000
#: Entries of the lexicon and of the exceptions, at most.
MAX_ENTRIES = 2_000
#: Lengths of word beginnings that can become entries.
STEMS = (4, 5, 6)
#: Toxic texts an entry must be in.
LEAST_TEXTS = 5
#: Log odds an entry must reach.
LEAST_WEIGHT = 3.0
THRESHOLD = 0.7

#: Digits and signs written for letters.
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
#: Cyrillic and Greek letters that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "е": "e", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h", "о": "o",
    "р": "p", "с": "c", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "һ": "h", "ԛ": "q",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g",
}


class Fold(dict):
    """Character table, filled as characters are met."""

    def __missing__(self, code: int) -> str:
        char = unicodedata.normalize("NFKC", chr(code)).lower()
        char = "".join(DIGITS.get(c) or LOOK_ALIKES.get(c) or c for c in char)
        out = self[code] = char if char.isalpha() else "" if unicodedata.combining(chr(code)) else " "
        return out


FOLD = Fold()


def fold(text: str) -> str:
    """Words of plain letters, one blank around each."""
    return f" {' '.join(text.translate(FOLD).split())} "


def features(words: list[str]) -> set[str]:
    """Whole words (between blanks) and word beginnings (after a blank)."""
    out = set()
    for word in set(words):
        out.add(f" {word} ")
        for n in STEMS:
            if len(word) > n:
                out.add(f" {word[:n]}")
    return out


@dataclass
class Model:
    """Entries and exceptions with weights, and the calibration."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: dict[str, float] = field(default_factory=dict)
    calibration: tuple[float, ...] = (-4.0, 1.0, 0.0, 0.0)

    def __post_init__(self):
        self.automaton = None

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "automaton"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.automaton = None

    def found(self, text: str) -> tuple[float, int, int]:
        """Weight of all matches less exceptions, number of matches, number of words."""
        folded = fold(text)
        words = folded.count(" ") - 1 if folded.strip() else 0
        if not self.weights:
            return 0.0, 0, words
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                self.automaton.add_word(entry, (weight, 1))
            for phrase, weight in self.exceptions.items():
                self.automaton.add_word(phrase, (-weight, -1))
            self.automaton.make_automaton()
        total, number = 0.0, 0
        for _, (weight, one) in self.automaton.iter(folded):
            total += weight
            number += one
        return max(total, 0.0), max(number, 0), words

    def score(self, text: str) -> float:
        z = float(np.dot(self.calibration, inputs(*self.found(text))))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def inputs(weight: float, number: int, words: int) -> list[float]:
    """Constant, any weight at all, weight by length, weight in total."""
    return [1.0, float(number > 0), math.log1p(100 * weight / (words + 20)), math.log1p(weight)]


def fit(
    labelled: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    max_rows: int = MAX_ROWS, max_entries: int = MAX_ENTRIES,
) -> Model:
    """Learn from rows with a label of 0 or 1, at most about ``max_rows`` of them.

    Rows with a null label or text are left out; without toxic rows the lexicon
    is empty and every score low.
    """
    labels = F.col(label).cast("int")
    rows = labelled.filter(labels.isin(0, 1) & F.col(text).isNotNull())
    rows = rows.select(F.col(text).alias("text"), labels.alias("label"), F.xxhash64(F.col(key).cast("string")).alias("order"))
    share = min(1.0, max_rows / max(1, rows.count()))
    rows = rows.filter(F.pmod("order", F.lit(1 << 20)) < int(share * (1 << 20))).drop("order")
    rows = store(rows.repartition(max(1, max_rows // 1000)), "toxic-rows")
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic:
        return Model()

    def weight(row) -> float:
        return math.log((row["toxic"] + 0.5) / (toxic + 1)) - math.log((row["clean"] + 0.5) / (clean + 1))

    # only features of toxic texts can become entries
    seen = _count(rows, lambda words: features(words), LEAST_TEXTS)
    best = sorted(
        ((weight(r), r["toxic"], r["feature"]) for r in _top(seen, toxic, clean, 4 * max_entries)),
        key=lambda x: (-x[1] * min(x[0], 6.0), len(x[2]), x[2]),
    )
    weights: dict[str, float] = {}
    for value, _, entry in best:
        stems = (entry[: n + 1] for n in STEMS)
        if len(weights) < max_entries and not any(s in weights and s != entry for s in stems):
            if entry[-1] != " ":
                weights = {w: v for w, v in weights.items() if not w.startswith(entry)}
            weights[entry] = value

    entries = set(weights)

    def phrases(words: list[str]) -> set[str]:
        out = set()
        for i, word in enumerate(words):
            if f" {word} " in entries or any(f" {word[:n]}" in entries for n in STEMS):
                if i:
                    out.add(f" {words[i - 1]} {word} ")
                if i + 1 < len(words):
                    out.add(f" {word} {words[i + 1]} ")
        return out

    around = _count(rows, phrases, 0).filter("clean >= 5 and clean > 4 * toxic")
    exceptions = {}
    for r in around.orderBy(F.desc("clean"), "feature").limit(max_entries).collect():
        hit = [w for word in r["feature"].split() for w in _entries_of(word, weights)]
        if hit:
            exceptions[r["feature"]] = max(weights[w] for w in hit)
    model = Model(weights, exceptions)
    model.calibration = _calibrate(rows, model)
    return model


def _entries_of(word: str, weights: dict[str, float]) -> list[str]:
    return [e for e in (f" {word} ", *(f" {word[:n]}" for n in STEMS)) if e in weights]


def _top(seen: DataFrame, toxic: int, clean: int, most: int) -> list:
    value = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    rows = seen.withColumn("w", value).filter(F.col("w") >= LEAST_WEIGHT)
    return rows.orderBy(F.desc(F.col("toxic") * F.least("w", F.lit(6.0))), "feature").limit(most).collect()


def _count(rows: DataFrame, of, least: int) -> DataFrame:
    """In how many toxic and clean texts each feature is."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1), strict=True):
                counts[label.as_py()].update(of(fold(text.as_py()).split()))
        every = list({**counts[0], **counts[1]})
        for at in range(0, len(every), 50_000):
            some = every[at : at + 50_000]
            columns = [some, *([c[f] for f in some] for c in (counts[1], counts[0]))]
            schema = pa.schema([("feature", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])
            yield batch_of(schema, columns)

    found = rows.select("text", "label").mapInArrow(run, "feature string, toxic long, clean long")
    return (
        found.groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(F.col("toxic") >= least)
    )


def _calibrate(rows: DataFrame, model: Model, rounds: int = 30, ridge: float = 1.0) -> tuple[float, ...]:
    """Logistic regression on the (bounded) rows by Newton steps."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [inputs(*shared.value.found(t)) for t in batch.column(0).to_pylist()]
        schema = pa.schema([("x", pa.list_(pa.float64())), ("y", pa.int32())])
        yield batch_of(schema, [found, batch.column(1)])

    table = map_arrow(rows.select("text", "label"), run, "x array<double>, y int", "text").toArrow()
    x, y = np.array(table["x"].to_pylist()), table["y"].to_numpy().astype(float)
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - ridge * beta
        bend = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(len(beta))
        beta = beta + np.clip(np.linalg.solve(bend, slope), -5, 5)
    return tuple(beta.tolist())


def add_scores(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1), in place of a column of that name. Null and
    empty texts hold no match and score as such."""
    docs = without(docs, "score")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model = shared.value
        scores = [model.score(bytes(t).decode("utf-8", "replace")) for t in raw_texts(batch.column(place))]
        schema = pa.schema([*batch.schema, ("score", pa.float64())])
        yield batch_of(schema, [*batch.columns, scores])

    return map_arrow(docs, run, with_fields(docs.schema, "score double"), text)


def bucket(key: str, parts: int):
    """The fixed fold of a row: crc32 of the key as text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def training_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """Labelled rows whose ``crc32(key) mod 3`` is not 1; text, label and key only."""
    marks = labels.select(F.col(key).alias("_key"), F.col(label).alias("_label")).filter(bucket("_key", 3) != 1)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).filter(bucket("_key", 3) != 1)
    return rows.join(marks, "_key").toDF(key, text, label)
