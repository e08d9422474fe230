"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents are put in a shuffled order and cut into blocks of equally many
words. The schedule is a row of slots; slot t falls at the golden-ratio point frac(t * phi)
and belongs to the source whose share of the cumulative weights holds that point. The k-th
slot of a source reads its k-th block, starting over when the blocks are used up. So any
stretch of the schedule holds every source in nearly its weight, and no pass over a source
begins before the one before it has ended.

A source gets exactly the whole part of its target: slots beyond it are left out, and the
few that the points left short close the schedule.

Only numbers are shuffled, no texts. Orders and ranks are worked out inside buckets of the
shuffled order, so a source that holds most rows is spread over many tasks. The order is a hash of
id and text, so neither the layout of files nor an id that many rows share matters.

Defined results: a null or empty text has size 0 and is never taken, in no slot; a null source is a
source of its own, the last; repeated rows are mixed each by itself; a table without words
has targets of 0; columns of other names are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import islice
from re import finditer

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from kvartal.llm.frames import constant_array, place_of, unused
from kvartal.llm.words import WORD
from kvartal.sources.staging import stage

#: words in a block
BLOCK_WORDS = 512
#: a source is repeated at most so often
MOST_PASSES = 3
#: weights of the sources in order, repeating
WEIGHTS = (1, 2, 3)
#: slots whose ranks are worked out together
SLOT_RUN = 16_384
SEED = "mix"

#: 2^32 / golden ratio, odd; the points are its multiples modulo 2^32
GOLDEN = 2654435769
CIRCLE = 2**32


@dataclass(frozen=True)
class Mix:
    """``documents``: row, doc_id, source, size, order; ``targets``: a row per source;
    ``plan``: slot, source_no, pass, row, first (word of the document), words."""

    documents: DataFrame
    targets: DataFrame
    plan: DataFrame


def words_in(text: Column | str) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def golden_point(slot: Column) -> Column:
    """slot * GOLDEN modulo 2^32, without a product over 64 bits."""
    low, high = slot % 65536, F.floor(slot / 65536) % 65536
    return ((high * GOLDEN % 65536) * 65536 + low * GOLDEN) % CIRCLE


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_no, source_size, weight, target for rows of (source, size).

    Targets share all words by weight and stop at ``MOST_PASSES`` times the source. Sources
    stop in the order of size per weight, so one walk in that order finds the level at which
    the others share what is left. One row per source.
    """
    by_point = Window.orderBy(F.col("source").asc_nulls_last())
    totals = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("source_no", F.row_number().over(by_point))
    )
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), (F.col("source_no") - 1) % len(WEIGHTS))
    totals = totals.withColumn("weight", weight.cast("long")).withColumn(
        "most", F.col("source_size") * MOST_PASSES
    )
    rising = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    everything = Window.partitionBy()
    # the level if all sources before this one have stopped; the true one is the highest of them
    level = (
        F.sum("source_size").over(everything) - F.sum("most").over(rising) + F.col("most")
    ) / (F.sum("weight").over(everything) - F.sum("weight").over(rising) + F.col("weight"))
    return (
        totals.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .select(
            "source", "source_no", "source_size", "weight",
            F.least(
                F.col("most").cast("double"), F.col("level") * F.col("weight")
            ).alias("target"),
        )
    )


def _blocks_needed(targets: DataFrame, block: int) -> DataFrame:
    """Per source with words: blocks, slots for the whole part of the target, and its arc's end."""
    size, words = F.col("source_size"), F.floor("target")
    blocks = F.ceil(size / block)
    needed = targets.filter(size > 0).withColumn("quota", words.cast("long")).withColumn(
        "blocks", blocks.cast("long")
    )
    rest = F.col("quota") % size
    needed = needed.withColumn(
        "slots", (F.floor(F.col("quota") / size) * F.col("blocks") + F.ceil(rest / block)).cast("long")
    )
    so_far = Window.orderBy("source_no")
    share = F.sum("slots").over(so_far) / F.sum("slots").over(Window.partitionBy())
    return needed.filter(F.col("slots") > 0).withColumn(
        "arc_end", F.floor(share * CIRCLE).cast("long")
    )


def schedule(needed: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """slot, source_no, block, pass, words for every slot that a source uses."""
    spark = needed.sparkSession
    # one row per source, as the plan itself has
    arcs = needed.select("arc_end", "source_no", "slots").orderBy("arc_end").collect()
    if not arcs:
        return spark.createDataFrame(
            [], "slot long, source_no int, block long, pass long, words long"
        )
    total = sum(arc.slots for arc in arcs)
    ends = constant_array([arc.arc_end for arc in arcs])
    numbers = constant_array([arc.source_no for arc in arcs])
    place = place_of(golden_point(F.col("id")), ends, len(arcs))
    slots = spark.range(total).select(
        F.col("id").alias("slot"),
        F.floor(F.col("id") / SLOT_RUN).alias("run"),
        F.get(numbers, F.least(place, F.lit(len(arcs) - 1))).cast("int").alias("source_no"),
    )
    per_run = slots.groupBy("source_no", "run").agg(F.count(F.lit(1)).alias("in_run"))
    earlier = Window.partitionBy("source_no").orderBy("run").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = per_run.select(
        "source_no", "run", F.coalesce(F.sum("in_run").over(earlier), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("source_no", "run").orderBy("slot")
    ranked = (
        slots.withColumn("inside", F.row_number().over(inside) - 1)
        .join(before, ["source_no", "run"])
        .select("source_no", "slot", (F.col("before") + F.col("inside")).alias("k"))
    )
    given = per_run.groupBy("source_no").agg(F.sum("in_run").alias("given"))
    closing = (
        needed.join(given, "source_no", "left")
        .withColumn("given", F.coalesce("given", F.lit(0)))
        .filter(F.col("given") < F.col("slots"))
        .select("source_no", F.explode(F.sequence("given", F.col("slots") - 1)).alias("k"))
        .select("source_no", (F.lit(total) + F.col("k")).alias("slot"), "k")
    )
    size, k = F.col("source_size"), F.col("k")
    number = k % F.col("blocks")
    turn = F.floor(k / F.col("blocks"))
    start = turn * size + number * block
    return (
        ranked.unionByName(closing)
        # one row per source
        .join(needed.select("source_no", "source_size", "blocks", "slots", "quota"), "source_no")
        .filter(k < F.col("slots"))
        .select(
            "slot", "source_no",
            number.cast("long").alias("block"),
            turn.cast("long").alias("pass"),
            F.least(F.lit(block), size - number * block, F.col("quota") - start)
            .cast("long").alias("words"),
        )
    )


def _pieces(docs: DataFrame, block: int, bucket_digits: int) -> DataFrame:
    """The part of every document in each block of its source's shuffled order."""
    placed = docs.filter(F.col("size") > 0).withColumn(
        "bucket", F.substring("order", 1, bucket_digits)
    )
    sums = placed.groupBy("source_no", "bucket").agg(F.sum("size").alias("in_bucket"))
    earlier = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = sums.select(
        "source_no", "bucket", F.coalesce(F.sum("in_bucket").over(earlier), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("source_no", "bucket").orderBy("order", "row")
    start = F.col("before") + F.sum("size").over(inside) - F.col("size")
    end = F.col("start") + F.col("size")
    number = F.col("block")
    return (
        placed.join(before, ["source_no", "bucket"])
        .withColumn("start", start)
        .withColumn(
            "block",
            F.explode(F.sequence(
                F.floor(F.col("start") / block), F.floor((end - 1) / block)
            )),
        )
        .select(
            "source_no", "block", "row",
            (F.greatest("start", number * block) - F.col("start")).alias("first"),
            (F.greatest("start", number * block) - number * block).alias("from"),
            (F.least(end, (number + 1) * block) - number * block).alias("to"),
        )
    )


def shuffled_order(seed: str = SEED) -> Column:
    """Place of a document in its source's order: rows that are equal in id and text only share it."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), doc_id, F.lit(":"), F.md5(F.coalesce("text", F.lit("")))))


def mix(documents: DataFrame, block: int = BLOCK_WORDS, seed: str = SEED) -> Mix:
    """The mixture of documents(doc_id, text, source). Counting the words runs at once."""
    counted = documents.select(
        "doc_id", "source", words_in("text").alias("size"), shuffled_order(seed).alias("order"),
        F.monotonically_increasing_id().alias("row"),
    )
    return mix_sizes(stage(counted, "mix-sizes"), block)


def mix_sizes(counted: DataFrame, block: int = BLOCK_WORDS) -> Mix:
    """The same for a stored table of doc_id, source, size, order and a unique row number."""
    targets = stage(source_targets(counted.select("source", "size")).coalesce(1), "mix-targets")
    # one row per source
    docs = counted.join(
        targets.select(F.col("source").alias("_source"), "source_no"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).select("doc_id", "row", "source", "size", "source_no", "order")
    rows = counted.count()
    digits = next(d for d in range(1, 33) if 16**d * 2048 >= rows)
    slots = schedule(_blocks_needed(targets, block), block)
    plan = (
        slots.join(_pieces(docs, block, digits), ["source_no", "block"])
        .withColumn("words", F.least("to", "words") - F.col("from"))
        .filter(F.col("words") > 0)
        .select("slot", "source_no", "pass", "row", "first", "words")
    )
    return Mix(counted, targets, plan)


def words_taken(mixed: Mix) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document, and where in the schedule it
    stands: first_slot (null if nowhere), slots, slot_sum (of their numbers)."""
    taken = mixed.plan.groupBy("row").agg(
        F.sum("words").alias("taken"), F.min("slot").alias("first_slot"),
        F.count(F.lit(1)).alias("slots"), F.sum("slot").alias("slot_sum"),
    )
    targets = mixed.targets.select(
        F.col("source").alias("_source"), "source_size", "target"
    )
    none = F.lit(0)
    return (
        mixed.documents.join(taken, "row", "left")
        .join(targets, F.col("source").eqNullSafe(F.col("_source")))
        .select(
            "doc_id", "size", "source_size", "target",
            F.coalesce("taken", none).cast("long").alias("taken"), "first_slot",
            F.coalesce("slots", none).cast("long").alias("slots"),
            F.coalesce("slot_sum", none).cast("long").alias("slot_sum"),
        )
    )


def _first_words(texts: pd.Series, counts: pd.Series) -> pd.Series:
    """Each text up to the end of its first so many words."""
    return pd.Series([
        next(islice((m.end() for m in finditer(WORD, text)), int(n) - 1, None), len(text))
        for text, n in zip(texts, counts, strict=True)
    ]).combine(texts, lambda end, text: text[:end])


def mixed_documents(documents: DataFrame) -> DataFrame:
    """The mixture as documents with the columns they came with.

    A document stands as often as the mix takes it whole. The source's last pass ends inside
    at most one document, of which one further row keeps the first words; its n_chars, if
    there is such a column, follows. Documents that are not taken go. Rows are not put in the order of the
    schedule, which would move all texts once more; ``mix`` tells their slots.
    """
    columns = documents.columns
    row, size, times, order, rest = (
        unused(documents, name) for name in ("_row", "_size", "_times", "_order", "_rest")
    )
    numbered = stage(
        documents.withColumns({
            row: F.monotonically_increasing_id(), size: words_in("text"), order: shuffled_order()
        }),
        "mix-documents",
    )
    mixed = mix_sizes(numbered.select(
        "doc_id", "source", F.col(size).alias("size"), F.col(order).alias("order"), F.col(row).alias("row")
    ))
    taken = mixed.plan.groupBy(F.col("row").alias(row)).agg(F.sum("words").alias(times))
    # numbers only, so that the texts are shuffled once
    turns = stage(
        numbered.select(row, size).join(taken, row).select(
            row, F.floor(F.col(times) / F.col(size)).alias(times), (F.col(times) % F.col(size)).alias(rest)
        ),
        "mix-turns",
    )
    whole = numbered.join(turns.filter(F.col(times) > 0).select(row, times), row).withColumn(
        times, F.explode(F.sequence(F.lit(1), F.col(times)))
    )
    # a row per source at most
    ends = stage(turns.filter(F.col(rest) > 0).select(row, rest).coalesce(1), "mix-ends")
    cut = numbered.join(ends, row)
    cut = cut.withColumn("text", F.pandas_udf(_first_words, "string")("text", rest))
    if "n_chars" in columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(documents.schema["n_chars"].dataType))
    return whole.select(*columns).unionByName(cut.select(*columns))
