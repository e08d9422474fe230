"""Quality rules: boosted trees over statistics of whole documents.

Statistics of a document are worked out in one pass over its text. The trees are fitted
on a bounded sample of labelled documents, may only fall along chosen statistics, and are
flattened into arrays, so that a batch of documents walks all trees at once.

Defined results: a null or empty text has no words and fails the rules; without any labels,
or with labels of one kind only, the rules alone decide; repeated rows get the same verdict;
a document with a null id is scored like any other; columns of any name pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from kvartal.llm.frames import bounded_batches, unused
from kvartal.llm.words import SHINGLE, WordHashes, utf8, window_hashes

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20

#: labelled documents that the trees are fitted on, at most
LABELLED_SAMPLE = 4_000
#: documents scored below this chance of being good are rejected
LEAST_CHANCE = 0.3

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: name and allowed direction: -1 may only lower the chance of a good document as it grows
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "stutter_share": -1,
    "distinct_share": 0,
    "top_word_share": -1,
    "upper_share": -1,
    "digit_share": -1,
    "mark_share": 0,
    "exclaim_per_word": -1,
    "bar_per_word": -1,
    "words_per_line": 0,
    "short_line_share": 0,
    "other_letter_share": 0,
}
STATISTICS = (
    ", ".join(f"{name} long" for name in BASE) + ", "
    + ", ".join(f"{name} double" for name in FEATURES)
)


# ---------------------------------------------------------------- statistics


def repeated_words(windows: np.ndarray, n_words: int) -> int:
    """Words inside windows that occur twice or more, the first occurrence included."""
    if not len(windows):
        return 0
    _, which, times = np.unique(windows, return_inverse=True, return_counts=True)
    again = (times[which] > 1).astype(np.int64)
    edges = np.zeros(n_words + 1, np.int64)
    edges[: len(again)] += again
    edges[SHINGLE : SHINGLE + len(again)] -= again
    return int(np.count_nonzero(np.cumsum(edges)))


def statistics(text: str | None, hashes: WordHashes) -> tuple:
    """The base counts and then the features of one whole text."""
    data = utf8(text)
    words = data.split()
    n = len(words)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    spaces = int(counts[9:14].sum() + counts[32])
    chars = len(data) - int(counts[0x80:0xC0].sum())
    lines = [line for line in data.split(b"\n") if line.strip()]
    dup_lines = len(lines) - len(set(lines))
    hashed = hashes.of(words)
    repeats = repeated_words(window_hashes(hashed), n)
    symbols = int(counts[list(SYMBOLS)].sum())
    base = (n, chars - spaces, symbols, dup_lines, repeats)

    per_word, per_char, per_line = max(n, 1), max(chars - spaces, 1), max(len(lines), 1)
    times = np.unique(hashed, return_counts=True)[1] if n else np.zeros(1, np.int64)
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    digits = int(counts[48:58].sum())
    other = int(counts[0xC0:].sum())
    marks = int(counts[33:127].sum()) - upper - lower - digits
    return (
        *base,
        float(np.log1p(n)),
        (chars - spaces) / per_word,
        symbols / per_word,
        dup_lines / per_line,
        repeats / per_word,
        float(np.count_nonzero(hashed[1:] == hashed[:-1])) / per_word,
        (len(times) if n else 0) / per_word,
        float(times.max()) / per_word,
        upper / max(upper + lower, 1),
        digits / per_char,
        marks / per_char,
        int(counts[33]) / per_word,
        int(counts[124]) / per_word,
        n / per_line,
        sum(1 for line in lines if len(line) < 20) / per_line,
        other / per_char,
    )


def _statistics(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    names = [*BASE, *FEATURES]
    for texts in batches:
        yield pd.DataFrame([statistics(text, hashes) for text in texts], columns=names)


def document_statistics(text: Column | str) -> Column:
    """Struct of the base counts and the features of a text."""
    return F.pandas_udf(_statistics, STATISTICS)(text)


# ---------------------------------------------------------------- trees


@dataclass(frozen=True)
class Trees:
    """All nodes of all trees in flat arrays; a leaf points at itself."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def chance(self, rows: np.ndarray) -> np.ndarray:
        """Chance of a good document, for a matrix with one row per document."""
        at = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
        row = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            at = np.where(rows[row, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
        return 1 / (1 + np.exp(-(self.start + self.value[at].sum(axis=1))))


def fit_trees(
    rows: np.ndarray, good: np.ndarray, directions: list[int], *, trees: int = 60, depth: int = 3,
    rate: float = 0.15, bins: int = 32, ridge: float = 1.0, least: float = 4.0,
) -> Trees:
    """Gradient boosting with logistic loss on binned features.

    A split on a feature with a direction must not go against it, and the middle of its two
    values bounds everything below, so that the whole sum is monotonic.
    """
    n, width = rows.shape
    points = np.linspace(0, 1, bins + 1)[1:-1]
    cuts = [np.unique(np.quantile(rows[:, f], points)) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], rows[:, f]) for f in range(width)], axis=1)
    cells = binned + np.arange(width) * bins
    share = min(max(float(good.mean()), 1e-6), 1 - 1e-6)
    start = float(np.log(share / (1 - share)))
    score = np.full(n, start)
    nodes: list[list[float]] = []  # feature, cut, left, right, value
    roots = []

    def leaf(value: float) -> int:
        nodes.append([0, 0.0, len(nodes), len(nodes), value])
        return len(nodes) - 1

    def best_split(own: np.ndarray, low: float, high: float):
        g = np.bincount(cells[own].ravel(), np.repeat(slope[own], width), width * bins)
        h = np.bincount(cells[own].ravel(), np.repeat(bend[own], width), width * bins)
        g, h = g.reshape(width, bins).cumsum(1), h.reshape(width, bins).cumsum(1)
        all_g, all_h = g[:, -1:], h[:, -1:]
        below = np.clip(-g / (h + ridge), low, high)
        above = np.clip(-(all_g - g) / (all_h - h + ridge), low, high)
        gain = -(
            g * below + (h + ridge) * below**2 / 2
            + (all_g - g) * above + (all_h - h + ridge) * above**2 / 2
        ) - all_g**2 / (all_h + ridge) / 2
        ok = (h >= least / 4) & (all_h - h >= least / 4)
        for f, direction in enumerate(directions):
            ok[f, len(cuts[f]):] = False
            if direction:
                ok[f] &= direction * (above[f] - below[f]) >= 0
        gain = np.where(ok, gain, -np.inf)
        f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
        return (f, b, below[f, b], above[f, b]) if gain[f, b] > 1e-6 else None

    def grow(own: np.ndarray, level: int, low: float, high: float, value: float) -> int:
        split = best_split(own, low, high) if level < depth and len(own) > 1 else None
        if split is None:
            score[own] += rate * value
            return leaf(rate * value)
        f, b, below, above = split
        here = leaf(0.0)
        goes = binned[own, f] <= b
        middle = (below + above) / 2
        bounds = {-1: ((middle, high), (low, middle)), 1: ((low, middle), (middle, high))}
        left, right = bounds.get(directions[f], ((low, high), (low, high)))
        nodes[here] = [
            f, cuts[f][b],
            grow(own[goes], level + 1, *left, below),
            grow(own[~goes], level + 1, *right, above),
            0.0,
        ]
        return here

    for _ in range(trees):
        chance = 1 / (1 + np.exp(-score))
        slope, bend = chance - good, chance * (1 - chance)
        total = -slope.sum() / (bend.sum() + ridge)
        roots.append(grow(np.arange(n), 0, -np.inf, np.inf, total))
    feature, cut, left, right, value = (np.array(column) for column in zip(*nodes, strict=True))
    as_index = lambda column: column.astype(np.int32)
    return Trees(
        as_index(feature), cut.astype(float), as_index(left), as_index(right),
        value.astype(float), as_index(np.array(roots)), depth, start,
    )


def train(documents: DataFrame, labels: DataFrame, sample: int = LABELLED_SAMPLE) -> Trees | None:
    """Trees from at most ``sample`` labelled documents, the same ones in every run.

    None if the labels are empty or all of one kind: there is nothing to learn then.
    """
    chosen = (
        labels.select("doc_id", "quality")
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )
    # at most `sample` rows of two numbers
    found = (
        documents.select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .select("_quality", F.xxhash64("doc_id", "text").alias("_order"),
                document_statistics("text").alias("_s"))
        .select("_quality", "_order", *(F.col(f"_s.{name}") for name in FEATURES))
        .orderBy("_order")
        .limit(sample)
        .toPandas()
    )
    good = (found["_quality"].to_numpy() > 0).astype(float)
    if not len(found) or good.min() == good.max():
        return None
    return fit_trees(found[list(FEATURES)].to_numpy(float), good, list(FEATURES.values()))


def _scorer(trees: Trees):
    @F.pandas_udf("double")
    def chance(statistics: pd.DataFrame) -> pd.Series:
        return pd.Series(trees.chance(statistics[list(FEATURES)].to_numpy(float)))

    return chance


# ---------------------------------------------------------------- operator


def score_documents(documents: DataFrame, trees: Trees | None, name: str) -> DataFrame:
    """All columns, and a struct ``name``: base counts, base_failed, chance, kept.

    Without trees the chance is null and the rules alone decide.
    """
    bounded_batches(documents.sparkSession)
    counted, judged = unused(documents, "_statistics"), unused(documents, "_chance")
    s = F.col(counted)
    failed = (s.n_words < LEAST_WORDS) | (
        100 * s.n_repeat_words > MOST_REPEATED_PERCENT * s.n_words
    )
    chance = _scorer(trees)(s) if trees is not None else F.lit(None).cast("double")
    return (
        documents.withColumn(counted, document_statistics("text"))
        .withColumn(judged, chance)
        .select(
            *documents.columns,
            F.struct(
                *(s[base].alias(base) for base in BASE),
                failed.alias("base_failed"),
                F.col(judged).alias("chance"),
                (~failed & F.coalesce(F.col(judged) >= LEAST_CHANCE, F.lit(True))).alias("kept"),
            ).alias(name),
        )
    )


def quality_verdicts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, base counts, base_failed, kept and chance of every document."""
    documents = documents.select("doc_id", "text")
    scored = score_documents(documents, train(documents, labels), "_quality")
    names = (*BASE, "base_failed", "kept", "chance")
    return scored.select("doc_id", *(F.col(f"_quality.{name}").alias(name) for name in names))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with."""
    name = unused(documents, "_quality")
    scored = score_documents(documents, train(documents, labels), name)
    return scored.filter(F.col(name)["kept"]).select(*documents.columns)
