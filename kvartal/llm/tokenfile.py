"""Token-id files with keyed access by a minimal perfect hash index.

Format. A file set is a Parquet table with a row per shard. Shards hold whole documents in
ascending id order. A row has the shard's first key, its raw payload (ids of all its
documents one after another, little-endian, 2 bytes each if the vocabulary allows, else 4)
and an index: every document key of the shard is mapped to its own slot of arrays without
gaps, which hold a 32-bit fingerprint of the key, the offset and the number of ids.

A key is (document id, occurrence): repeated ids are told apart by their order in the file.
Which shard can hold a key follows from the shards' first keys; within the shard, one hash, one
seed and one slot give the offset, and the stored fingerprint tells a foreign key.

The index is built by hash and displace: keys are dealt into small buckets, and the largest
buckets choose first a seed that sends their keys to free slots.

Written by Spark's Parquet writer, so any store that Spark reaches will do, and a lost
executor's shards are written again.

Defined results: a null or empty text is its end id alone; null ids come first; repeated
rows are stored each by itself; an empty table has no shards; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kvartal.llm.frames import NO_ID, bounded_batches, constant_array, place_of
from kvartal.llm.words import mixed
from kvartal.sources.staging import staged_path

END_ID = 0
#: a shard is closed when it has this many ids, and at a document's end
SHARD_IDS = 1_000_000
#: keys in a bucket of the index, on average
BUCKET_KEYS = 4
SHARDS = (
    "first_id long, first_occurrence long, n_docs long, n_ids long, id_bytes int, payload binary, "
    "seeds binary, fingerprints binary, offsets binary, lengths binary, keys binary"
)


# ---------------------------------------------------------------- minimal perfect hash


def _hashes(ids: np.ndarray, occurrences: np.ndarray, salt: int) -> np.ndarray:
    one = mixed(ids.astype(np.int64).view(np.uint64) + np.uint64(salt) * np.uint64(0x9E3779B97F4A7C15))
    return mixed(one ^ (occurrences.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))


def _slots(hashes: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    return (mixed(hashes ^ mixed(seeds.astype(np.uint64) + np.uint64(1))) % np.uint64(n)).astype(np.int64)


def _buckets(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(17)) % np.uint64(max(1, n // BUCKET_KEYS))).astype(np.int64)


def build_index(ids: np.ndarray, occurrences: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seed of every bucket, and slot and fingerprint of every key, for distinct keys."""
    n = len(ids)
    hashes = _hashes(ids, occurrences, 0)
    buckets = _buckets(hashes, n)
    count = max(1, n // BUCKET_KEYS)
    order = np.argsort(buckets, kind="stable")
    sizes = np.bincount(buckets, minlength=count)
    ends = np.cumsum(sizes)
    seeds = np.zeros(count, np.uint32)
    slots = np.empty(n, np.int64)
    free = np.ones(n, bool)
    tries = np.arange(64, dtype=np.uint64)
    for bucket in np.argsort(-sizes, kind="stable"):
        if not sizes[bucket]:
            break
        own = order[ends[bucket] - sizes[bucket] : ends[bucket]]
        base = 0
        while True:
            wanted = _slots(hashes[own][None, :], (tries + np.uint64(base))[:, None], n)
            fits = free[wanted].all(axis=1)
            if len(own) > 1:
                ranked = np.sort(wanted, axis=1)
                fits &= (ranked[:, 1:] != ranked[:, :-1]).all(axis=1)
            if fits.any():
                first = int(np.argmax(fits))
                seeds[bucket], slots[own] = base + first, wanted[first]
                free[wanted[first]] = False
                break
            base += len(tries)
    return seeds, slots, fingerprints(ids, occurrences)


def fingerprints(ids: np.ndarray, occurrences: np.ndarray) -> np.ndarray:
    return (_hashes(ids, occurrences, 1) >> np.uint64(32)).astype(np.uint32)


def find(shard, ids: np.ndarray, occurrences: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For keys asked of a shard: whether it holds them, their offsets and numbers of ids."""
    seeds = np.frombuffer(shard.seeds, "<u4")
    stored = np.frombuffer(shard.fingerprints, "<u4")
    hashes = _hashes(ids, occurrences, 0)
    slots = _slots(hashes, seeds[_buckets(hashes, len(stored))], len(stored))
    keys = np.frombuffer(shard.keys, "<i8").reshape(2, -1)[:, slots]
    same = (keys[0] == ids) & (keys[1] == occurrences)  # a foreign key may share a fingerprint
    return (
        same & (stored[slots] == fingerprints(ids, occurrences)),
        np.frombuffer(shard.offsets, "<i8")[slots],
        np.frombuffer(shard.lengths, "<i8")[slots],
    )


def ids_at(shard, offset: int, length: int) -> np.ndarray:
    """Ids of a document, from the raw payload."""
    kind = f"<u{shard.id_bytes}"
    return np.frombuffer(shard.payload, kind, int(length), int(offset) * int(shard.id_bytes))


# ---------------------------------------------------------------- writing


def _shard(rows: list[tuple[int, int, np.ndarray]], id_bytes: int) -> tuple:
    ids, occurrences, parts = zip(*rows, strict=True)
    ids, occurrences = np.array(ids, np.int64), np.array(occurrences, np.int64)
    lengths = np.array([len(part) for part in parts], np.int64)
    seeds, slots, prints = build_index(ids, occurrences)
    by_slot = np.argsort(slots)
    offsets = np.cumsum(lengths) - lengths
    return (
        int(ids[0]), int(occurrences[0]), len(ids), int(lengths.sum()), id_bytes,
        np.concatenate(parts).astype(f"<u{id_bytes}").tobytes(),
        seeds.astype("<u4").tobytes(), prints[by_slot].astype("<u4").tobytes(),
        offsets[by_slot].astype("<i8").tobytes(), lengths[by_slot].astype("<i8").tobytes(),
        np.stack([ids, occurrences])[:, by_slot].astype("<i8").tobytes(),
    )


def write_shards(
    documents: DataFrame, encoder: Callable, path: str, *,
    end_id: int = END_ID, id_bytes: int = 2, shard_ids: int = SHARD_IDS,
) -> None:
    """Write the ids of documents(doc_id, text) as a file set, in ascending id order."""
    names = [field.split()[0] for field in SHARDS.split(", ")]

    def shards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = encoder()
        end = np.array([end_id], "<u4")
        rows: list[tuple[int, int, np.ndarray]] = []
        held, last, occurrence = 0, None, 0
        for batch in batches:
            for key, text in zip(batch["key"], batch["text"], strict=True):
                occurrence = occurrence + 1 if key == last else 0
                last = key
                ids = np.concatenate([np.frombuffer(tokens.of(text), "<u4"), end])
                rows.append((key, occurrence, ids.astype(f"<u{id_bytes}")))
                held += len(ids)
                if held >= shard_ids:
                    yield pd.DataFrame([_shard(rows, id_bytes)], columns=names)
                    rows, held = [], 0
        if rows:
            yield pd.DataFrame([_shard(rows, id_bytes)], columns=names)

    bounded_batches(documents.sparkSession)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    (
        documents.select(key.alias("key"), "text")
        .repartitionByRange("key")
        .sortWithinPartitions("key", "text")
        .mapInPandas(shards, SHARDS)
        .write.option("compression", "zstd")
        .parquet(path)
    )


# ---------------------------------------------------------------- reading


def shard_starts(shards: DataFrame) -> DataFrame:
    """first_id, first_occurrence, start (ids of all shards before); a row per shard."""
    before = Window.orderBy("first_id", "first_occurrence").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return shards.select("first_id", "first_occurrence", "n_ids").select(
        "first_id", "first_occurrence",
        F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"),
    )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, found by its key in the index."""
    shards = spark.read.schema(SHARDS).parquet(path)

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard in batch.itertuples(index=False):
                ids, occurrences = np.frombuffer(shard.keys, "<i8").reshape(2, -1)
                held, offsets, lengths = find(shard, ids, occurrences)
                assert held.all(), "a stored key has a foreign fingerprint"
                yield pd.DataFrame({
                    "first_id": shard.first_id,
                    "first_occurrence": shard.first_occurrence,
                    "doc_id": pd.array(ids, "Int64").to_numpy(object, na_value=None),
                    "offset": offsets,
                    "n_tokens": lengths,
                    "ids_crc32": [
                        zlib.crc32(ids_at(shard, o, n).astype("<u4").tobytes())
                        for o, n in zip(offsets, lengths, strict=True)
                    ],
                })

    found = shards.mapInPandas(
        documents,
        "first_id long, first_occurrence long, doc_id long, offset long, n_tokens long, ids_crc32 long",
    )
    return found.join(shard_starts(shards), ["first_id", "first_occurrence"]).select(
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"),
        (F.col("start") + F.col("offset")).alias("start"),
        "n_tokens", "ids_crc32",
    )


def look_up(spark: SparkSession, path: str, keys: DataFrame) -> DataFrame:
    """doc_id, occurrence, ids (array) for the asked keys(doc_id, occurrence) that are stored."""
    shards = spark.read.schema(SHARDS).parquet(path)
    firsts = sorted(  # a number per shard
        row.first_id for row in shards.filter("first_occurrence = 0").select("first_id").collect()
    )
    if not firsts:
        return spark.createDataFrame([], "doc_id long, occurrence long, ids array<int>")
    bounds = constant_array(firsts)

    def own(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for shard in right.itertuples(index=False):
            ids, occurrences = (left[c].to_numpy(np.int64) for c in ("doc_id", "occurrence"))
            held, offsets, lengths = find(shard, ids, occurrences)
            rows += [
                (ids[i], occurrences[i], ids_at(shard, offsets[i], lengths[i]).tolist())
                for i in np.flatnonzero(held)
            ]
        return pd.DataFrame(rows, columns=["doc_id", "occurrence", "ids"])

    asked = keys.withColumn("range", place_of(F.col("doc_id"), bounds, len(firsts)))
    stored = shards.withColumn("range", place_of(F.col("first_id"), bounds, len(firsts)))
    wanted = stored.join(asked.select("range").distinct(), "range", "left_semi")
    return (
        asked.groupBy("range")
        .cogroup(wanted.groupBy("range"))
        .applyInPandas(own, "doc_id long, occurrence long, ids array<int>")
    )


def round_trip(documents: DataFrame, encoder: Callable) -> DataFrame:
    """Write the file set into the shared folder and read every document back from it."""
    path = staged_path(documents.sparkSession, "token-ids")
    write_shards(documents.select("doc_id", "text"), encoder, path)
    return read_documents(documents.sparkSession, path)
