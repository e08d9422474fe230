"""Near-duplicate groups: MinHash bands, sequential Bayesian pruning, exact verification.

A document is the set of its distinct runs of five words. Documents with the same words in
the same order are one class from the start, and only one of a class goes on. Signatures of
200 hashes are cut into 40 bands; classes that agree in a band share a bucket and are
candidates. At the threshold a pair is missed with a chance below 3 in 100,000.

Candidates are compared one batch of signature values after another. After each, the chance
that the pair is similar enough follows from its matches so far (a Beta posterior); a pair
below the chosen miss probability is given up. What survives is compared on full texts.

Groups are joined without listing pairs: in every bucket, all members are compared with its
best-connected one only, each member at first with the best of these over all its buckets and then
with those that this has not joined it to. Members linked so are one component and need no more comparison
among themselves. Where a bucket of three or more still holds several components, the rest is
compared inside tasks, which give out only pairs that survive: every member outside the
bucket's largest component with all members of other components. For this, longer signatures
of these documents are worked out, independent of the bands. A large bucket is cut into blocks,
the members of its largest component by themselves and the others by themselves, and blocks meet
in pairs. So a bucket of any size is settled exactly, no comparison holds more than two blocks,
and near copies of one text cost a comparison each. First every member proposes the one partner
that it matches best; the proposals are verified and the components they join need no more
pairs. What is open after some such rounds is compared with all its partners, so none is missed: members
that long signatures leave a partner meet inside tasks with their whole sets, as hashes of 64 bits,
and only similar pairs that join two components become rows, fewer than there are members in the two
blocks. They are confirmed on the words like all others. Sets above 4,096 shingles stay out of this, so that
a comparison holds no more than 130 MB of them: their surviving pairs are rows, all of them. The
comparisons of members outside the largest component, which are not rows, still grow with the
square of their number.

Components spread their smallest label along links with shortcuts, as joins and grouped minima;
every round is a written table.

Defined results: a null text or one without words is linked with nothing; fewer than five
words are one shingle, the whole sequence; a null id counts as the largest when a component's
smallest id is chosen, and a component of null ids only has a null id; repeated rows are
copies; columns of other names are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kvartal.llm.frames import small_batches, unused
from kvartal.llm.words import SHINGLE, WordHashes, mixed, sequence_digest, utf8, window_hashes
from kvartal.sources.staging import stage

BANDS, BAND_ROWS = 40, 5
HASHES = BANDS * BAND_ROWS
#: signature values compared at a time
BATCH = 40
#: a pair is given up when it is similar enough with less than this chance
MISS = 1e-5
#: similar: 100 * intersection >= NEAR_PERCENT * union
NEAR_PERCENT = 75
#: ids that a join may be told to broadcast; they are counted first
BROADCAST_IDS = 500_000
#: bitmaps of 32,768 rows, 4 kB each, that a join may be told to broadcast; they are counted first
BITMAPS = 4096
#: ids in a file of a table that is small enough to be broadcast
FILE_IDS = 50_000
#: values of the longer signatures, of which 8 bits are kept
LONG = 512
LONG_BATCH = 64
#: members of a bucket that are compared in one block
BLOCK = 2048
#: shingles up to which a member's whole set is compared inside tasks
WHOLE_SET = 4096
#: sets compared with one at a time
SETS_AT_ONCE = 64
#: joins of components that a task remembers
REMEMBERED_JOINS = 1_000_000
#: a member's place in a pair of blocks
PLACE = {"bucket": "long", "block": "long", "beside": "long", "row": "long", "component": "long", "first": "boolean"}
#: rounds in which every member of an open bucket proposes its best pair only, before all the others
BEST_ROUNDS = 2

_RNG = np.random.default_rng(20)
_FACTORS = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIPS = _RNG.integers(0, 2**63, HASHES, dtype=np.uint64)
_LONG_FACTORS = _RNG.integers(0, 2**63, LONG, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LONG_FLIPS = _RNG.integers(0, 2**63, LONG, dtype=np.uint64)
_BAND_SALT = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))

SKETCH = "row long, doc_id long, key binary, n_shingles long, signature binary, bands array<long>"


# ---------------------------------------------------------------- sketches


def _least(shingles: np.ndarray, flips: np.ndarray, factors: np.ndarray, at_once: int = 1024) -> np.ndarray:
    """Smallest value of every hash function over the shingles."""
    least = np.full(len(flips), np.iinfo(np.uint64).max)
    for i in range(0, len(shingles), at_once):
        part = (shingles[i : i + at_once, None] ^ flips) * factors
        np.minimum(least, part.min(axis=0), out=least)
    return least


def signature(shingles: np.ndarray) -> np.ndarray:
    return (_least(shingles, _FLIPS, _FACTORS) >> np.uint64(32)).astype(np.uint32)


def long_signature(shingles: np.ndarray) -> np.ndarray:
    return mixed(_least(shingles, _LONG_FLIPS, _LONG_FACTORS)).astype(np.uint8)


def band_keys(values: np.ndarray) -> np.ndarray:
    rows = values.reshape(BANDS, BAND_ROWS).astype(np.uint64)
    keys = _BAND_SALT.copy()
    for i in range(BAND_ROWS):
        keys = mixed(keys ^ rows[:, i])
    return keys.view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    kinds = (pa.binary(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            words = utf8(text.as_py()).lower().split()
            if len(words) < SHINGLE:
                rows.append((sequence_digest(words) if words else None, int(bool(words)), None, None))
                continue
            shingles = np.unique(window_hashes(hashes.of(words)))
            values = signature(shingles)
            rows.append((sequence_digest(words), len(shingles),
                         values.astype("<u2").tobytes(), band_keys(values)))
        columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("doc_id"),
             *(pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True))],
            names=[field.split()[0] for field in SKETCH.split(", ")],
        )


# ---------------------------------------------------------------- verification


def least_matches(
    hashes: int = HASHES, batch: int = BATCH, bits: int = 32, miss: float = MISS
) -> dict[int, int]:
    """For every number of compared values the fewest matches that keep a pair.

    With m of n equal and no prior knowledge the chance that two values are equal has a
    Beta(m + 1, n - m + 1) posterior, and its chance of reaching t is that of at most m
    successes in n + 1 with t. Values cut to few bits are also equal by accident.
    """
    t, kept = NEAR_PERCENT / 100, {}
    t += (1 - t) / 2**bits
    for n in range(batch, hashes + 1, batch):
        chance = 0.0
        for m in range(n + 1):
            chance += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if chance >= miss:
                kept[n] = m
                break
    return kept


_LEAST = least_matches(bits=16)  # signatures keep 16 bits of a value
_LONG_LEAST = least_matches(LONG, LONG_BATCH, 8)


def promising(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which rows of two signature matrices survive all batches."""
    alive, matches = np.arange(len(one)), np.zeros(len(one), np.int64)
    for n, least in _LEAST.items():
        part = slice(n - BATCH, n)
        matches[alive] += (one[alive, part] == other[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    kept = np.zeros(len(one), bool)
    kept[alive] = True
    return kept


def _promising(one: pd.Series, other: pd.Series) -> pd.Series:
    as_matrix = lambda s: np.frombuffer(b"".join(s), "<u2").reshape(-1, HASHES)
    return pd.Series(promising(as_matrix(one), as_matrix(other)))


def shingle_set(text: str | None) -> set:
    words = utf8(text).lower().split()
    if len(words) < SHINGLE:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(SHINGLE)), strict=False))


def _near(one: pd.Series, other: pd.Series) -> pd.Series:
    result, last, a = [], None, set()
    for x, y in zip(one, other, strict=True):
        if x is not last and x != last:
            last, a = x, shingle_set(x)
        b = shingle_set(y)
        common = len(a & b)
        result.append(100 * common >= NEAR_PERCENT * (len(a) + len(b) - common))
    return pd.Series(result, dtype=bool)


def _small(ids: DataFrame, count: int | None = None) -> DataFrame:
    """A stored table of ids, with a broadcast hint if there are few of them."""
    count = ids.count() if count is None else count
    return F.broadcast(ids) if count <= BROADCAST_IDS else ids


def _rows_of(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """The rows of a table that stored pairs name, so that no others are shuffled."""
    ids = stage(
        pairs.select(F.col("a").alias("row")).unionAll(pairs.select("b")).distinct(), "pair-rows"
    )
    return table.join(_small(ids), "row", "left_semi")


def _of_marked(table: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of a table whose number is among the ids, by one bit for every row: row numbers are dense in
    the parts of the table that they were given in, so their bitmaps are few and the table is not shuffled."""
    number, place = F.bitmap_bucket_number("row"), F.bitmap_bit_position("row")
    marks = stage(
        ids.select(number.alias("_number"), place.alias("_place")).repartition("_number")
        .groupBy("_number").agg(F.bitmap_construct_agg("_place").alias("_bits")),
        "row-bitmaps",
    )
    if marks.count() > BITMAPS:
        return table.join(ids, "row", "left_semi")
    byte = F.substring("_bits", (place / 8).cast("int") + 1, F.lit(1))
    bit = F.expr("shiftleft(1L, cast(bitmap_bit_position(row) % 8 AS int))")
    is_set = F.conv(F.hex(byte), 16, 10).cast("bigint").bitwiseAND(bit) != 0
    return table.join(F.broadcast(marks), number == F.col("_number")).filter(is_set).select(*table.columns)


def verified(pairs: DataFrame, sketches: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the distinct pairs (a, b) that are similar, as a stored table."""
    return _confirmed(_promising_pairs(stage(pairs, "pairs"), sketches), texts)


def _promising_pairs(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    sketched = _rows_of(pairs, sketches.select("row", "n_shingles", "signature"))
    side = lambda name: sketched.select(
        F.col("row").alias(name), F.col("n_shingles").alias(f"n_{name}"),
        F.col("signature").alias(f"s_{name}"),
    )
    ratio = 100 * F.least("n_a", "n_b") >= NEAR_PERCENT * F.greatest("n_a", "n_b")
    return stage(
        pairs.join(side("a"), "a").join(side("b"), "b").filter(ratio)
        .filter(F.pandas_udf(_promising, "boolean")("s_a", "s_b")).select("a", "b"),
        "survivors",
    )


def _confirmed(survivors: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the stored pairs whose sets of words are similar, as a stored table."""
    wanted = _rows_of(survivors, texts.select("row", "text"))
    return stage(
        survivors
        .join(wanted.select(F.col("row").alias("b"), F.col("text").alias("t_b")), "b")
        .join(wanted.select(F.col("row").alias("a"), F.col("text").alias("t_a")), "a")
        .filter(F.pandas_udf(_near, "boolean")("t_a", "t_b"))
        .select("a", "b"),
        "links",
    )


# ---------------------------------------------------------------- components


def components(links: DataFrame) -> DataFrame:
    """(row, component): the smallest row reachable over links (a, b), for all linked rows."""
    edges = stage(
        links.select("a", "b").unionAll(links.select("b", "a"))
        .filter("a <> b").distinct().select(F.col("a").alias("row"), F.col("b").alias("beside")),
        "edges",
    )
    labels = stage(
        edges.groupBy("row").agg(F.least("row", F.min("beside")).alias("component")), "labels"
    )
    count = labels.count()  # stays the same
    while True:
        beside = labels.select(F.col("row").alias("beside"), F.col("component").alias("theirs"))
        hooked = (
            edges.join(_small(beside, count), "beside")
            .groupBy("row").agg(F.min("theirs").alias("theirs"))
            .join(_small(labels, count), "row")
            .select("row", "component", F.least("component", "theirs").alias("hooked"))
        )
        further = labels.select(F.col("row").alias("hooked"), F.col("component").alias("further"))
        found = hooked.join(_small(further, count), "hooked").select(
            "row", "component", F.least("hooked", "further").alias("new")
        )
        if count <= BROADCAST_IDS:  # a few files are enough
            found = found.coalesce(count // FILE_IDS + 1)
        moved = stage(found, "labels")
        labels = moved.select("row", F.col("new").alias("component"))
        if not moved.filter("new <> component").limit(1).count():
            return labels


def _followed(labels: DataFrame, more: DataFrame) -> DataFrame:
    """Labels after more links between their components."""
    count = labels.count()
    own = lambda name: _small(labels.select(
        F.col("row").alias(name), F.col("component").alias(f"c_{name}")
    ), count)
    of = lambda name: F.coalesce(f"c_{name}", name).alias(name)
    lifted = components(
        more.join(own("a"), "a", "left").join(own("b"), "b", "left").select(of("a"), of("b"))
    )
    up = lifted.select(F.col("row").alias("component"), F.col("component").alias("up"))
    kept = labels.join(_small(up), "component", "left").select(
        "row", F.coalesce("up", "component").alias("component")
    )
    new = lifted.join(_small(labels, count), "row", "left_anti")
    return stage(kept.unionByName(new), "labels")


# ---------------------------------------------------------------- candidates


def _shared_buckets(representatives: DataFrame) -> DataFrame:
    """(bucket, row, weight) of all buckets with two members or more, as a stored table.

    A member's weight is the number of companions it has over all buckets: what a text was
    copied from has more than its copies have.
    """
    members = representatives.select("row", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stage(members.join(sizes, "bucket"), "buckets")
    weights = shared.groupBy("row").agg(F.sum("n").alias("weight"))
    return stage(shared.join(weights, "row").select("bucket", "row", "weight"), "weighed-buckets")


def _hub_pairs(shared: DataFrame) -> DataFrame:
    """(row, hub, weight): every member with the heaviest of each of its buckets (the smallest row
    among equals) and that one's weight, as a stored table."""
    best = F.max(F.struct("weight", (-F.col("row")).alias("less")))
    hubs = shared.groupBy("bucket").agg(best.alias("best")).select(
        "bucket", (-F.col("best.less")).alias("hub"), F.col("best.weight").alias("weight")
    )
    pairs = shared.select("bucket", "row").join(hubs, "bucket").filter("row <> hub")
    return stage(pairs.select("row", "hub", "weight").distinct(), "hub-pairs")


def _best_hubs(pairs: DataFrame) -> DataFrame:
    """Of every member the pair with its heaviest hub."""
    best = F.max(F.struct("weight", (-F.col("hub")).alias("less")))
    return pairs.groupBy("row").agg(best.alias("best")).select(
        F.col("row").alias("x"), (-F.col("best.less")).alias("y")
    )


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (x, y) of hubs and members that no component joins yet."""
    count = labels.count()
    of = lambda name: _small(labels.select(
        F.col("row").alias(name), F.col("component").alias(f"c_{name}")
    ), count)
    own = lambda name: F.coalesce(f"c_{name}", name)
    return (
        pairs.select(F.col("row").alias("x"), F.col("hub").alias("y"))
        .join(of("x"), "x", "left").join(of("y"), "y", "left")
        .filter(own("x") != own("y")).select("x", "y")
    )


def _open(shared: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets of three or more that hold several components, as a stored table:
    bucket, row, component, main (whether it is the bucket's largest), main_blocks and blocks (of
    the members in the largest component and of the others).
    """
    labelled = shared.join(_small(labels), "row", "left").select(
        "bucket", "row", F.coalesce("component", "row").alias("component")
    )
    per_component = labelled.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    largest = F.max(F.struct("n", (-F.col("component")).alias("less"))).alias("largest")
    several = (
        per_component.groupBy("bucket")
        .agg(F.sum("n").alias("members"), F.count(F.lit(1)).alias("components"), largest)
        .filter("components > 1 AND members > 2")
        .select(
            "bucket", (-F.col("largest.less")).alias("_main"),
            F.ceil(F.col("largest.n") / BLOCK).alias("main_blocks"),
            F.ceil((F.col("members") - F.col("largest.n")) / BLOCK).alias("blocks"),
        )
    )
    return stage(
        labelled.join(several, "bucket").select(
            "bucket", "row", "component", (F.col("component") == F.col("_main")).alias("main"),
            "main_blocks", "blocks",
        ),
        "open-buckets",
    )


def _long_signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for batch in batches:
        yield pd.DataFrame({
            "row": batch["row"],
            "long": [_marks_and_long(t, hashes) for t in batch["text"]],
        })


def _marks_and_long(text: str, hashes: WordHashes) -> bytes:
    """32 bits of every band key, then the long signature."""
    shingles = np.unique(window_hashes(hashes.of(utf8(text).lower().split())))
    marks = band_keys(signature(shingles)).astype("<u4")
    return marks.tobytes() + long_signature(shingles).tobytes()


def _survivors(block: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of two blocks each member of the first, all outside the main component, that long signatures leave
    partners among the second and, beside the first main block, among others of the first of larger row:
    its place, theirs, and how many values match."""
    row, component = block["row"].to_numpy(), block["component"].to_numpy()
    first, among = block["first"].to_numpy(), block["beside"].iloc[0] == -1
    values = _marks_and_values(block)[1]
    for i in np.flatnonzero(first):
        alive = np.flatnonzero((component != component[i]) & (~first | (among & (row > row[i]))))
        matches = np.zeros(len(alive), np.int64)
        for n, least in _LONG_LEAST.items():
            part = slice(n - LONG_BATCH, n)
            matches += (values[alive, part] == values[i, part]).sum(axis=1)
            kept = matches >= least
            alive, matches = alive[kept], matches[kept]
            if not len(alive):
                break
        if len(alive):
            yield i, alive, matches


def _marks_and_values(block: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(block["long"]), np.uint8).reshape(-1, 4 * BANDS + LONG)
    return np.ascontiguousarray(both[:, : 4 * BANDS]).view("<u4"), both[:, 4 * BANDS :]


def _told_here(block: pd.DataFrame) -> Iterator[tuple[int, np.ndarray]]:
    """Each member with its surviving partners, the best matching first. A pair that shares several bands
    is told in the first of them only; should that bucket hold no third member, the pair has been compared
    with it as its hub."""
    marks = _marks_and_values(block)[0]
    mark = np.array(block["bucket"].iloc[0], np.int64).astype("<u4")
    for i, alive, matches in _survivors(block):
        alive = alive[np.argsort(-matches, kind="stable")]
        band = (marks[alive] == marks[i]).argmax(axis=1)
        alive = alive[marks[i, band] == mark]
        if len(alive):
            yield i, alive


def _pairs_frame(pairs: Iterator[tuple[int, int]]) -> pd.DataFrame:
    return pd.DataFrame(list(pairs), columns=["x", "y"], dtype=np.int64).drop_duplicates()


def _best_pairs(block: pd.DataFrame) -> pd.DataFrame:
    """Of every member the pair that matches best."""
    row = block["row"].to_numpy()
    return _pairs_frame((row[i], row[alive[matches.argmax()]]) for i, alive, matches in _survivors(block))


def _standing(block: pd.DataFrame) -> pd.DataFrame:
    """The members that stand in a surviving pair told here."""
    stands = np.zeros(len(block), bool)
    for i, alive in _told_here(block):
        stands[i] = True
        stands[alive] = True
    return block.loc[stands, list(PLACE)]


def _root(parents: dict[int, int], one: int) -> int:
    path = []
    while one in parents:
        path.append(one)
        one = parents[one]
    parents.update(dict.fromkeys(path, one))
    return one


def _near_sets(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Which of some sets, as sorted hashes, are similar to one."""
    sizes = np.array([len(other) for other in others])
    together = np.concatenate(others)
    found = one[np.minimum(np.searchsorted(one, together), len(one) - 1)] == together
    common = np.add.reduceat(found.astype(np.int64), np.cumsum(sizes) - sizes)
    return 100 * common >= NEAR_PERCENT * (len(one) + sizes - common)


def _joining_pairs(block: pd.DataFrame, parents: dict[int, int]) -> Iterator[tuple[int, int]]:
    """Similar pairs that join two components each, by ``parents`` and the pairs before; and all surviving
    pairs with a member whose set is not given."""
    row, component = block["row"].to_numpy(), block["component"].tolist()
    sets = [None if s is None else np.frombuffer(s, "<u8") for s in block["shingles"]]
    for i, alive in _told_here(block):
        if sets[i] is None:
            yield from ((row[i], row[j]) for j in alive)
            continue
        yield from ((row[i], row[j]) for j in alive if sets[j] is None)
        whole = [j for j in alive if sets[j] is not None]
        for k in range(0, len(whole), SETS_AT_ONCE):
            mine = _root(parents, component[i])
            apart = [j for j in whole[k : k + SETS_AT_ONCE] if _root(parents, component[j]) != mine]
            near = _near_sets(sets[i], [sets[j] for j in apart]) if apart else ()
            for j, linked in zip(apart, near, strict=True):
                a, b = _root(parents, component[i]), _root(parents, component[j])
                if linked and a != b:
                    parents[max(a, b)] = min(a, b)
                    yield row[i], row[j]


def _joining(parents: dict[int, int]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def told(block: pd.DataFrame) -> pd.DataFrame:
        if len(parents) > REMEMBERED_JOINS:
            parents.clear()
        return _pairs_frame(_joining_pairs(block, parents))

    return told


def _sorted_blocks(
    batches: Iterator[pd.DataFrame], told: Callable[[pd.DataFrame], pd.DataFrame]
) -> Iterator[pd.DataFrame]:
    """What is told of sorted pairs of blocks; of the rows read, only the last two blocks are held."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        key = batch[["bucket", "block", "beside"]].to_numpy()
        edges = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(batch)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if held and (held[0][["bucket", "block", "beside"]].iloc[0].to_numpy() != key[a]).any():
                yield told(pd.concat(held, ignore_index=True))
                held = []
            held.append(batch.iloc[a:b])
    if held:
        yield told(pd.concat(held, ignore_index=True))


def _dealt(rest: DataFrame) -> DataFrame:
    """bucket, block, beside, row, component, first: the pairs of blocks that every member stands in.

    Blocks of outside members count from 0, those of the main component down from -1; the first
    of a pair is one of outside members.
    """
    outside, main = F.sequence(F.lit(0), F.col("blocks") - 1), F.sequence(F.lit(0), F.col("main_blocks") - 1)
    at = F.pmod(F.xxhash64("row"), F.when(F.col("main"), F.col("main_blocks")).otherwise(F.col("blocks")))
    pair = lambda block, beside: F.struct(
        block.cast("long").alias("block"), beside.cast("long").alias("beside")
    )
    own = F.col("at")
    every = F.when(F.col("main"), F.transform(outside, lambda o: pair(o, -1 - own))).otherwise(F.concat(
        F.transform(main, lambda m: pair(own, -1 - m)),
        F.transform(
            F.filter(outside, lambda o: o != own), lambda o: pair(F.least(o, own), F.greatest(o, own))
        ),
    ))
    return (
        rest.withColumn("at", at)
        .select("bucket", "row", "component", "main", "at", F.explode(every).alias("pair"))
        .select("bucket", "pair.block", "pair.beside", "row", "component",
                (~F.col("main") & (own == F.col("pair.block"))).alias("first"))
    )


def _signed(rest: DataFrame, texts: DataFrame) -> DataFrame:
    """Long signatures of all members of the open buckets, as a stored table."""
    rows = stage(rest.select("row").distinct(), "open-rows")
    return stage(
        texts.select("row", "text").join(_small(rows), "row", "left_semi")
        .mapInPandas(_long_signatures, "row long, long binary"),
        "long-signatures",
    )


def _by_blocks(dealt: DataFrame) -> DataFrame:
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(parts, "bucket", "block", "beside").sortWithinPartitions("bucket", "block", "beside")


def _proposed_pairs(rest: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs (x, y) between components of the open buckets: of every member that which matches best."""
    return _by_blocks(_dealt(rest).join(signed, "row")).mapInPandas(
        lambda batches: _sorted_blocks(batches, _best_pairs), "x long, y long"
    )


def _shingle_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes = WordHashes()
    for batch in batches:
        sets = (np.unique(window_hashes(hashes.of(utf8(t).lower().split()))) for t in batch["text"])
        yield pd.DataFrame({
            "row": batch["row"],
            "shingles": [s.astype("<u8").tobytes() if len(s) <= WHOLE_SET else None for s in sets],
        })


def _left_pairs(rest: DataFrame, signed: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (x, y) that join the components of the open buckets.

    Members that stand in a pair which long signatures leave meet once more, with their sets."""
    standing = stage(
        _by_blocks(_dealt(rest).join(signed, "row")).mapInPandas(
            lambda batches: _sorted_blocks(batches, _standing),
            ", ".join(f"{name} {kind}" for name, kind in PLACE.items()),
        ),
        "standing-rows",
    )
    rows = stage(standing.select("row").distinct(), "standing-ids")
    sets = stage(
        texts.select("row", "text").join(_small(rows), "row", "left_semi")
        .mapInPandas(_shingle_sets, "row long, shingles binary"),
        "shingle-sets",
    )
    return _by_blocks(standing.join(signed, "row").join(sets, "row")).mapInPandas(
        lambda batches: _sorted_blocks(batches, _joining({})), "x long, y long"
    )


def _distinct_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def linked_components(sketches: DataFrame, representatives: DataFrame, texts: DataFrame) -> DataFrame:
    """(row, component) of all representatives that are linked with another."""
    shared = _shared_buckets(representatives)
    pairs = _hub_pairs(shared)
    labels = components(verified(_distinct_pairs(_best_hubs(pairs)), sketches, texts))
    labels = _followed(labels, verified(_distinct_pairs(_apart(pairs, labels)), sketches, texts))
    rest = _open(shared, labels)
    if not rest.limit(1).count():
        return labels
    signed = _signed(rest, texts)
    for _ in range(BEST_ROUNDS):
        links = verified(_distinct_pairs(_proposed_pairs(rest, signed)), sketches, texts)
        if not links.limit(1).count():
            break
        labels = _followed(labels, links)
        rest = _open(shared, labels)
    # not pruned again: of the links between two components only one is told
    left = stage(_distinct_pairs(_left_pairs(rest, signed, texts)), "pairs")
    return _followed(labels, _confirmed(left, texts))


# ---------------------------------------------------------------- operator


def near_duplicates(texts: DataFrame) -> DataFrame:
    """row, doc_id, n_shingles, component (a row number; null without words), component_id.

    ``texts`` is a stored table of a unique row number, doc_id and text; jobs run at once.
    """
    with small_batches(texts.sparkSession):
        return _near_duplicates(texts)


def _near_duplicates(texts: DataFrame) -> DataFrame:
    sketches = stage(
        texts.select("row", F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
            _sketches, SKETCH
        ),
        "sketches",
    )
    classes = stage(
        sketches.filter(F.col("key").isNotNull()).groupBy("key").agg(
            F.min("row").alias("row"), F.min("doc_id").alias("first_id")
        ),
        "classes",
    )
    representatives = _of_marked(
        sketches.filter(F.col("bands").isNotNull()).select("row", "bands"), classes.select("row")
    )
    labels = linked_components(sketches, representatives, texts)
    labelled = stage(
        classes.join(labels, "row", "left").select(
            "key", "first_id", F.coalesce("component", "row").alias("component")
        ),
        "labelled-classes",
    )
    smallest = labelled.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_class = labelled.join(smallest, "component").select("key", "component", "component_id")
    return sketches.select("row", "doc_id", "n_shingles", "key").join(by_class, "key", "left").select(
        "row", "doc_id", "n_shingles", "component",
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"),
    )


def _numbered(documents: DataFrame, row: str) -> DataFrame:
    return stage(documents.withColumn(row, F.monotonically_increasing_id()), "numbered-documents")


def duplicate_groups(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    found = near_duplicates(_numbered(documents.select("doc_id", "text"), "row"))
    kept: Column = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def one_of_each(documents: DataFrame) -> DataFrame:
    """The documents without all but one of each group: the one of smallest id, then row."""
    row = unused(documents, "_row")
    numbered = _numbered(documents, row)
    found = stage(
        near_duplicates(numbered.select(F.col(row).alias("row"), "doc_id", "text"))
        .filter(F.col("component").isNotNull()),
        "groups",
    )
    stays = found.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("stays")
    )
    goes = stage(
        found.join(stays, "component").filter(F.col("row") != F.col("stays.row"))
        .select(F.col("row").alias(row)),
        "dropped-rows",
    )
    return numbered.join(goes, row, "left_anti").select(*documents.columns)
