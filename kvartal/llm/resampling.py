"""Documents drawn towards a target corpus by importance of their hashed n-grams.

A text is lower-cased (A to Z only), its separators are collapsed to single spaces, and an
overlapped regular-expression scan with look-arounds at both borders gives the span of every
run of words. The CRC of a span picks its bucket. A bucket's gain is the logarithm of its share
in the target over its share in the documents, both smoothed by one; a document's weight is the
mean gain of its features. With Gumbel noise from a hash of its id added to the weight, the
highest scores are a sample without replacement whose chances follow the weights.

Texts are scanned once: buckets and counts of a document are written and read again to weigh
it. Tasks send one count per bucket that they have seen. Ranks are numbered inside ranges of
scores, which copies of a row do not keep together.

Defined results: a null text or one without words has no features and weight 0; a null id is
hashed as an empty string and comes last among equal scores; repeated rows are drawn
separately, ranked one after another; an empty target has no counts; without documents there
are no rows; columns of other names are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from kvartal.llm.frames import small_batches
from kvartal.llm.words import utf8
from kvartal.operators.ordering import SLICE, range_sliced
from kvartal.sources.staging import stage

BUCKETS = 10_000
#: documents with fewer words are weighed but not drawn
LEAST_WORDS = 20
#: every byte that is neither a letter, a digit nor part of a longer character becomes a space
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)
FEATURES = "doc_id long, n_words long, n_features long, buckets binary, counts binary"


# ---------------------------------------------------------------- scanning


def collapsed(text: str | None) -> bytes:
    """Words of the text with one space between them."""
    return b" ".join(utf8(text).translate(_FOLDED).split())


def run_pattern(words: int) -> regex.Pattern:
    """A run of so many words, from border to border."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (words - 1))


def scanned(data: bytes, patterns: list[regex.Pattern]) -> Iterator[tuple[int, int]]:
    """Spans of all runs; the next one may begin inside the one before."""
    for pattern in patterns:
        for found in pattern.finditer(data, overlapped=True):
            yield found.span()


def bucket_counts(data: bytes, patterns: list[regex.Pattern], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of all runs in ascending order, and how many runs each holds."""
    times = Counter(data[start:end] for start, end in scanned(data, patterns))
    found = np.fromiter(map(zlib.crc32, times), np.int64, len(times)) % buckets
    distinct, place = np.unique(found, return_inverse=True)
    counts = np.zeros(len(distinct), np.int64)
    np.add.at(counts, place, np.fromiter(times.values(), np.int64, len(times)))
    return distinct.astype("<u4"), counts.astype("<u4")


def _scan(sizes: range, buckets: int) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [run_pattern(n) for n in sizes]
        for batch in batches:
            words, totals, where, counts = [], [], [], []
            for text in batch.column("text"):
                data = collapsed(text.as_py())
                found, times = bucket_counts(data, patterns, buckets)
                words.append(data.count(b" ") + 1 if data else 0)
                totals.append(int(times.sum()))
                where.append(found.tobytes())
                counts.append(times.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words, pa.int64()), pa.array(totals, pa.int64()),
                 pa.array(where, pa.binary()), pa.array(counts, pa.binary())],
                names=["doc_id", "n_words", "n_features", "buckets", "counts"],
            )

    return scan


def features(texts: DataFrame, least: int, most: int, buckets: int) -> DataFrame:
    """doc_id, n_words, n_features, buckets and counts of every text, as a stored table."""
    with small_batches(texts.sparkSession):
        return stage(
            texts.select("doc_id", "text").mapInArrow(_scan(range(least, most + 1), buckets), FEATURES),
            "bucket-counts",
        )


# ---------------------------------------------------------------- gains


def _added(buckets: int) -> Callable:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            where, counts = (
                np.frombuffer(b"".join(batch.column(name).to_pylist()), "<u4") for name in ("buckets", "counts")
            )
            total += np.bincount(where, counts, buckets).astype(np.int64)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["bucket", "n"])

    return add


def bucket_totals(counted: DataFrame, buckets: int) -> np.ndarray:
    """Features of all texts per bucket: a task sends one row per bucket, the driver gets as many."""
    rows = (
        counted.select("buckets", "counts").mapInArrow(_added(buckets), "bucket long, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    )
    totals = np.zeros(buckets, np.int64)
    for row in rows:
        totals[row.bucket] = row.n
    return totals


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    buckets, own_total, target_total = len(own), int(own.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(
            (float(t + 1) * float(own_total + buckets)) / (float(s + 1) * float(target_total + buckets))
        ))
        for s, t in zip(own.tolist(), target.tolist(), strict=True)
    ], np.int64)


def _weigh(gain: np.ndarray) -> Callable:
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = []
            for where, counts, n in zip(*(batch.column(c).to_pylist() for c in ("buckets", "counts", "n_features"))):
                total = int(gain[np.frombuffer(where, "<u4")] @ np.frombuffer(counts, "<u4").astype(np.int64))
                weights.append(total // n if n else 0)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "n_words", "n_features")), pa.array(weights, pa.int64())],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return weigh


# ---------------------------------------------------------------- drawing


def _ranked(drawable: DataFrame, order: list[str]) -> DataFrame:
    """The rows with rank 1, 2, 3, ... by ``order``."""
    sliced = range_sliced(drawable, order, "ranges-of-scores")
    sizes = sliced.groupBy(SLICE).agg(F.count(F.lit(1)).alias("n"))  # one row per slice
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(SLICE, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy(SLICE).orderBy(*(F.col(c).asc_nulls_first() for c in order))
    return sliced.join(F.broadcast(offsets), SLICE).withColumn(
        "rank", (F.row_number().over(inside) + F.col("before")).cast("long")
    )


def importance_sample(
    documents: DataFrame, target: DataFrame, *, percent: int, seed: str, least: int = 1, most: int = 1,
    buckets: int = BUCKETS, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank (null if not drawn) of every document.

    ``target`` has a column text; features are runs of ``least`` to ``most`` words; ``percent``
    of the documents with at least ``least_words`` words are drawn. Jobs run at once.
    """
    own = features(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), least, most, buckets)
    wanted = features(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), least, most, buckets)
    gain = gains(bucket_totals(own, buckets), bucket_totals(wanted, buckets))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    scored = stage(
        own.mapInArrow(_weigh(gain), "doc_id long, n_words long, n_features long, weight long")
        .withColumn("score", F.col("weight") + noise)
        .withColumn("descending", -F.col("score"))
        .withColumn("no_id", F.col("doc_id").isNull())
        .withColumn("row", F.monotonically_increasing_id()),
        "scored",
    )
    can = F.col("n_words") >= least_words
    drawable = scored.filter(can)
    draws = drawable.count() * percent // 100
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    ranked = _ranked(drawable, ["descending", "no_id", "doc_id", "n_features", "weight", "row"])
    rank = F.when(F.col("rank") <= draws, F.col("rank"))
    return ranked.select(*columns, rank.alias("rank")).unionByName(
        scored.filter(~can).select(*columns, F.lit(None).cast("long").alias("rank"))
    )
