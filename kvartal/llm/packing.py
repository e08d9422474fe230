"""Packing documents into sequences of equal length by Karmarkar-Karp differencing.

A document's ids are cut every ``length`` ids; the full pieces are sequences by themselves.
One last piece in a dozen, by hash, is cut small. The last pieces are dealt into bins of a few thousand by hash and every bin is parted into
the fewest windows that could hold it: the two partial partitions that are furthest from
even are merged again and again, the heaviest windows of the one onto the lightest of the
other, until one partition is left. If its heaviest window is beyond the capacity, the bin
is parted anew with one window more. Windows of a bin come out nearly equal, and only the
last window's worth of each bin can be padding.

Only numbers are shuffled. A bin's size does not depend on sources, keys or lengths, so a
hot one cannot grow it.

Defined results: a null or empty text is its end id alone, one piece of length 1; repeated
rows are packed each by itself, and a null id stays null; an empty table has no pieces;
columns of other names are not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kvartal.llm.frames import NO_ID, bounded_batches
from kvartal.sources.staging import stage

#: ids in a sequence
LENGTH = 4096
END_ID = 2
#: last pieces that are parted together, on average
BIN_PIECES = 4096
#: one last piece in so many is cut small, to even out what the long ones leave
CHANGE_EVERY = 12
CHANGE_LENGTH = 64

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = f"{PIECES}, sequence_id long, offset long"


# ---------------------------------------------------------------- differencing


def _merged(heavy: np.ndarray, light: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Opposing windows summed, heaviest first, and the order that sorts the sums."""
    sums = heavy + light[::-1]
    order = np.argsort(-sums, kind="stable")
    return sums[order], order


def differenced(lengths: np.ndarray, windows: int) -> np.ndarray:
    """Window of every length, by the largest differencing method over so many windows.

    A partial partition holds its windows' sums, heaviest first. Its imbalance is the first
    minus the last sum. Ties go by position, so the result is the same in every run.
    """
    n = len(lengths)
    if windows <= 1 or n <= 1:
        return np.zeros(n, np.int64)
    sums: dict[int, np.ndarray] = {}
    heap = []
    for i, length in enumerate(lengths):
        heap.append((-int(length), i))
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []

    def vector(part: int) -> np.ndarray:
        found = sums.pop(part, None)
        if found is None:
            found = np.zeros(windows, np.int64)
            found[0] = lengths[part]
        return found

    while len(heap) > 1:
        _, one = heapq.heappop(heap)
        _, two = heapq.heappop(heap)
        total, order = _merged(vector(one), vector(two))
        part = n + len(merges)
        merges.append((one, two, order))
        sums[part] = total
        heapq.heappush(heap, (-int(total[0] - total[-1]), part))
    # back from the whole partition: where each part's windows have ended up
    at: dict[int, np.ndarray] = {heap[0][1]: np.arange(windows)}
    result = np.zeros(n, np.int64)
    for part in range(n + len(merges) - 1, n - 1, -1):
        one, two, order = merges[part - n]
        final = np.empty(windows, np.int64)
        final[order] = at.pop(part)
        for child, places in ((one, final), (two, final[::-1])):
            if child < n:
                result[child] = places[0]
            else:
                at[child] = places
    return result


def parted(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Window of every length, none beyond the capacity, in nearly equal windows."""
    windows = max(1, -(-int(lengths.sum()) // capacity))
    while True:
        found = differenced(lengths, windows)
        if np.bincount(found, lengths, windows).max(initial=0) <= capacity:
            return found
        windows += 1


# ---------------------------------------------------------------- operator


def document_pieces(
    documents: DataFrame, encoder: Callable, length: int = LENGTH, end_id: int = END_ID
) -> DataFrame:
    """The pieces of every document, without their ids: see PIECES."""
    end = np.array([end_id], "<u4").tobytes()

    def cuts(doc_id: int | None, ids: bytes) -> list[int]:
        """Where the pieces start, and the end."""
        count = len(ids) // 4
        last = (count - 1) // length * length
        starts = list(range(0, last + 1, length))
        if zlib.crc32(ids, zlib.crc32(str(doc_id).encode())) % CHANGE_EVERY == 0:
            starts += range(last + CHANGE_LENGTH, count, CHANGE_LENGTH)
        return [*starts, count]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = tokens.of(text.as_py()) + end
                at = cuts(doc_id, ids)
                rows += (
                    (doc_id, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop]), at[-1])
                    for start, stop in zip(at, at[1:], strict=False)
                )
            columns = zip(*rows, strict=True) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    bounded_batches(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        pieces, PIECES
    )


def pack(pieces: DataFrame, length: int = LENGTH, bin_pieces: int = BIN_PIECES) -> DataFrame:
    """``pieces`` with sequence_id and offset. Ids of sequences are unique, not dense."""
    numbered = stage(
        pieces.withColumn("row", F.monotonically_increasing_id()), "pack-pieces"
    )
    bins = max(1, -(-numbered.count() // bin_pieces))
    # pandas would round ids beside a missing one
    dealt = (
        numbered.withColumn("bin", F.pmod(F.xxhash64("row"), F.lit(bins)))
        .withColumn("has_id", F.col("doc_id").isNotNull())
        .withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    )

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", ignore_index=True)
        lengths = rows["length"].to_numpy()
        full = lengths >= length
        window = np.empty(len(rows), np.int64)
        window[~full] = parted(lengths[~full], length)
        first = window[~full].max(initial=-1) + 1
        window[full] = first + np.arange(np.count_nonzero(full))
        rows = rows.assign(window=window).sort_values(["window", "row"], ignore_index=True)
        rows["offset"] = rows.groupby("window")["length"].cumsum() - rows["length"]
        # a bin has far fewer than 2^31 windows
        rows["sequence_id"] = rows["bin"] * 2**31 + rows["window"]
        return rows.drop(columns=["row", "bin", "window"])

    placed = dealt.groupBy("bin").applyInPandas(place, PACKED + ", has_id boolean")
    doc_id = F.when(F.col("has_id"), F.col("doc_id")).alias("doc_id")
    return placed.select(doc_id, *(name for name in placed.columns if name not in ("doc_id", "has_id")))


def packed_documents(documents: DataFrame, encoder: Callable) -> DataFrame:
    return pack(document_pieces(documents, encoder))
