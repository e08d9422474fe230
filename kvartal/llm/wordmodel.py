"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Every word is taken twice: as itself in lower case, and as its form, in which runs of letters,
digits and marks stand for themselves ("THE!!" is "X!!", a word like the one before it "="). Runs of
one and two words and of one to three forms are hashed into a fixed number of places; a place's
value is the root of its count, and a text's values have length one. So a score is a sparse dot
product whose cost follows the words of the text.

The model is fitted on a bounded sample of labelled documents, one after another: every place
keeps the sum of its slopes and of their squares, and its weight is the minimiser of all losses
so far with both penalties, zero while the sum is small.

Defined results: a null or empty text has the place of the constant only and gets a score like any
other; a label of a null id or a null label is not learned from, an id with several labels has the
smallest; of several rows with one id the smallest text is learned from; without labels, or with
labels of one kind, every score is the smoothed share of good ones; repeated rows get equal scores;
columns of other names are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from kvartal.llm.frames import small_batches
from kvartal.llm.words import REMEMBERED, REMEMBERED_BYTES, WordHashes, mixed, utf8, window_hashes
from kvartal.sources.staging import stage

#: weights of the model; place 0 is the constant
PLACES = 2**20
#: labelled documents that the model is fitted on, at most
LABELLED_SAMPLE = 3_000
WORD_RUNS, FORM_RUNS = (1, 2), (1, 2, 3)
#: learning: step size, its softening, penalties on size and square, passes over the sample
RATE, SOFTENING, SPARSITY, RIDGE, PASSES = 0.5, 1.0, 0.05, 0.1, 5

_SAME = np.uint64(0x5A17)
_RUNS = [(regex.compile(rb"[A-Z]+"), b"X"), (regex.compile(rb"[a-z\x80-\xff]+"), b"x"), (regex.compile(rb"[0-9]+"), b"0")]


# ---------------------------------------------------------------- features


class FormHashes(dict):
    """Hashes of the forms of words, each worked out once while it is remembered."""

    def __missing__(self, word: bytes) -> int:
        form = word
        for runs, sign in _RUNS:
            form = runs.sub(sign, form)
        value = xxhash.xxh64_intdigest(form, 1)
        if len(word) <= REMEMBERED_BYTES:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = value
        return value


def text_features(
    text: str | None, words: WordHashes, forms: FormHashes, places: int = PLACES
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places in ascending order and their values."""
    found = utf8(text).split()
    as_words = words.of([word.lower() for word in found])
    as_forms = np.fromiter(map(forms.__getitem__, found), np.uint64, len(found))
    as_forms[1:][as_words[1:] == as_words[:-1]] = _SAME
    runs = [mixed(window_hashes(as_words, n) ^ np.uint64(n)) for n in WORD_RUNS]
    runs += [mixed(window_hashes(as_forms, n) ^ np.uint64(16 + n)) for n in FORM_RUNS]
    hashed = np.concatenate(runs) % np.uint64(places - 1) + np.uint64(1)
    at, times = np.unique(np.concatenate([np.zeros(1, np.uint64), hashed]), return_counts=True)
    values = np.sqrt(times.astype(np.float32))
    return at.astype("<u4"), (values / np.sqrt((values * values).sum())).astype("<f4")


# ---------------------------------------------------------------- model


@dataclass(frozen=True)
class Model:
    """Weights that are not zero, by place, and the score where there is no weight at all."""

    places: np.ndarray
    weights: np.ndarray

    def full(self, size: int = PLACES) -> np.ndarray:
        weights = np.zeros(size, np.float32)
        weights[self.places] = self.weights
        return weights


def chance(dot: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(dot, -35, 35)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, *, size: int = PLACES, seed: int = 13) -> Model:
    """Follow-the-regularised-leader over the rows, in a new order in every pass."""
    slopes, squares = np.zeros(size), np.zeros(size)
    order = np.random.default_rng(seed)

    def weights_at(at: np.ndarray) -> np.ndarray:
        z = slopes[at]
        return np.where(
            np.abs(z) <= SPARSITY, 0.0,
            -(z - np.sign(z) * SPARSITY) / ((SOFTENING + np.sqrt(squares[at])) / RATE + RIDGE),
        )

    for _ in range(PASSES):
        for i in order.permutation(len(rows)):
            at, values = rows[i]
            weights = weights_at(at)
            slope = (chance(weights @ values) - good[i]) * values
            more = squares[at] + slope * slope
            slopes[at] += slope - (np.sqrt(more) - np.sqrt(squares[at])) / RATE * weights
            squares[at] = more
    seen = np.flatnonzero(squares)
    weights = weights_at(seen)
    kept = weights != 0
    return Model(seen[kept].astype(np.int64), weights[kept].astype(np.float32))


def constant_model(good: int, all_rows: int) -> Model:
    """The score of every text is about the smoothed share of good ones, as far as its constant carries."""
    share = (good + 1) / (all_rows + 2)
    return Model(np.zeros(1, np.int64), np.array([np.log(share / (1 - share))], np.float32))


def sparse_dots(features: list[tuple[np.ndarray, np.ndarray]], weights: np.ndarray) -> np.ndarray:
    """One dot product per text, all texts of a batch at once."""
    lengths = np.array([len(at) for at, _ in features])  # at least the constant's place
    products = weights[np.concatenate([at for at, _ in features])] * np.concatenate([v for _, v in features])
    return np.add.reduceat(products.astype(float), np.concatenate([[0], np.cumsum(lengths)[:-1]]))


# ---------------------------------------------------------------- sample


def held_out(doc_id: Column | str) -> Column:
    """Rows that the contract keeps from learning: a third of all ids; a null id is an empty text."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def labelled_sample(labels: DataFrame, label: str, sample: int) -> DataFrame:
    """(doc_id, good) of at most ``sample`` labelled ids that may be learned from, chosen by hash."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("good")).dropna()
    usable = usable.filter(~held_out("doc_id"))
    rows = usable.count()
    # so many more than wanted that the hash leaves enough, and no task has to sort many
    share = min(1.0, (1.2 * sample + 200) / max(rows, 1))
    bound = int(share * 2**40)
    return (
        usable.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2**40)) <= bound)
        .groupBy("doc_id").agg(F.min("good").alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )


def _packed_features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    words, forms = WordHashes(), FormHashes()
    for texts in batches:
        found = [text_features(text, words, forms) for text in texts]
        yield pd.DataFrame({"at": [a.tobytes() for a, _ in found], "v": [v.tobytes() for _, v in found]})


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", sample: int = LABELLED_SAMPLE) -> Model:
    """Model from at most ``sample`` labelled documents, the same ones in every run."""
    chosen = labelled_sample(labels, label, sample)
    texts = (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(F.broadcast(chosen), "doc_id")  # at most `sample` rows of two numbers
        .groupBy("doc_id").agg(F.min("good").alias("good"), F.min("text").alias("text"))
    )
    packed = F.pandas_udf(_packed_features, "at binary, v binary")
    rows = stage(texts.select("doc_id", "good", packed("text").alias("f")), "labelled-features")
    found = rows.orderBy("doc_id").select("good", "f.at", "f.v").collect()
    good = np.array([row.good > 0 for row in found], float)
    if not len(good) or good.min() == good.max():
        return constant_model(int(good.sum()), len(good))
    return fit([(np.frombuffer(row["at"], "<u4"), np.frombuffer(row.v, "<f4")) for row in found], good)


# ---------------------------------------------------------------- operator


def _scores(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, forms, weights = WordHashes(), FormHashes(), model.full()
        for batch in batches:
            if not batch.num_rows:
                continue
            found = [text_features(text.as_py(), words, forms) for text in batch.column("text")]
            scores = chance(sparse_dots(found, weights))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores)], names=["doc_id", "score"]
            )

    return score


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id and the chance that the document is good."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _scores(model), "doc_id long, score double"
    )


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document. Jobs run at once."""
    with small_batches(documents.sparkSession):
        scored = stage(score_documents(documents, train(documents, labels)), "quality-scores")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
