"""Document fingerprints: Merkle trees over paragraphs and sections.

A text is cut, without loss, into leaves: stretches of at most 200 characters that end at a
sentence's or a line's end. A paragraph is a line. A section is a run of paragraphs that
ends where the hash of a paragraph's last leaf begins with one of two digits, so an edit
moves no section border but its own. Leaves are hashed, paragraphs hash their leaves'
hashes, sections their paragraphs', the root its sections'.

The fingerprint is the root and, under it, the leaf hashes with a mark for every level's end
(blank, comma, semicolon). Equal roots tell equal texts. Else sections are compared, and
only differing ones are opened, which locates an edit.

SQL functions only; a tree is built from strings in one pass, so its cost is linear in the
text. Following documents are found inside ranges of ids, each range with the first document
of the next added, so texts are shuffled once and no task sees all.

Defined results: a null text is an empty one, whose tree has no leaves; two empty texts are
alike (1); null ids come first in the order, ties go by text; the document after the last is
the first, also when it is the only one; an empty table gives none; columns of other names
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from kvartal.llm.frames import NO_ID, constant_array, place_of

#: a leaf: characters without sentence or line end, then those ends
LEAF = r"[^\n.!?]{1,200}[.!?]*\n*|[.!?]+\n*|\n+"
#: hex digits kept of a leaf's SHA-256
LEAF_DIGITS = 16
#: a paragraph whose last leaf hash begins so ends a section: one in eight
SECTION_END = "01"
ROOT_DIGITS = 64


def tree(text: Column) -> Column:
    """Leaf hashes with the marks of the levels' ends, of a text that is not null."""

    def leaf(piece: Column) -> Column:
        digest = F.substring(F.sha2(piece, 256), 1, LEAF_DIGITS)
        ends = F.when(~piece.endswith("\n"), " ").otherwise(
            F.when(F.substring(digest, 1, 1).isin(*SECTION_END), ";").otherwise(",")
        )
        return F.concat(digest, ends)

    return F.concat_ws("", F.transform(F.regexp_extract_all(text, F.lit(LEAF), 0), leaf))


def sections_of(tree_text: Column) -> Column:
    """The sections of a tree, each as the text of its part."""
    return F.filter(F.split(tree_text, ";"), lambda part: part != "")


def root(tree_text: Column) -> Column:
    """Root hash: over section hashes, over paragraph hashes, over leaf hashes."""

    def section(part: Column) -> Column:
        return F.sha2(F.concat_ws("", F.transform(F.split(part, ","), lambda p: F.sha2(p, 256))), 256)

    return F.sha2(F.concat_ws("", F.transform(F.split(tree_text, ";"), section)), 256)


def fingerprint(text: Column) -> Column:
    """Root and tree in one string; null counts as empty."""
    built = tree(F.coalesce(text, F.lit("")))
    return F.transform(F.array(built), lambda t: F.concat(root(t), F.lit(":"), t))[0]


def tree_of(print_: Column) -> Column:
    return F.substring(print_, ROOT_DIGITS + 2, 2**31 - 1 - ROOT_DIGITS - 2)


def leaves_of(tree_text: Column) -> Column:
    """Distinct leaf hashes of a tree."""
    return F.array_distinct(
        F.filter(F.split(tree_text, "[ ,;]"), lambda leaf: leaf != "")
    )


def likeness(one: Column, other: Column) -> Column:
    """Twice the common distinct leaves by all of both (Dice), 0 to 1; equal roots are 1."""
    a, b = leaves_of(tree_of(one)), leaves_of(tree_of(other))
    shared = F.size(F.array_intersect(a, b)).cast("double")
    dice = 2 * shared / F.greatest(F.size(a) + F.size(b), F.lit(1))
    same = F.substring(one, 1, ROOT_DIGITS) == F.substring(other, 1, ROOT_DIGITS)
    return F.when(same, F.lit(1.0)).otherwise(dice)


def changed_sections(before: Column, after: Column) -> Column:
    """Distinct sections of the second fingerprint that the first does not have."""
    return F.size(F.array_except(sections_of(tree_of(after)), sections_of(tree_of(before))))


def changed_paragraphs(before: Column, after: Column) -> Column:
    """Distinct paragraphs, in differing sections only, that the first does not have."""
    opened = lambda one, other: F.split(
        F.concat_ws(",", F.array_except(sections_of(tree_of(one)), sections_of(tree_of(other)))), ","
    )
    return F.size(F.array_except(
        F.filter(opened(after, before), lambda p: p != ""), opened(before, after)
    ))


# ---------------------------------------------------------------- following documents


def in_ranges(documents: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, text and the columns of by_id, in ranges of ids that also hold the row after.

    Texts are not null. The rows after the ranges are marked by ``follows``; the last range is
    followed by the first row of all. Range bounds are quantiles of the ids; finding them runs
    at once.
    """
    spark = documents.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = documents.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("key"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    points = F.array(*(F.lit((i + 1) / ranges) for i in range(ranges - 1)))
    # one number per range
    found = docs.agg(F.percentile_approx("key", points, F.lit(10 * ranges))).first()[0]
    bounds = sorted(set(found or []))
    docs = docs.withColumn(
        "range", place_of(F.col("key"), constant_array(bounds), len(bounds)) if bounds else F.lit(0)
    )
    firsts = docs.groupBy("range").agg(F.min("key").alias("key"))
    in_order = Window.orderBy("range")  # over one row per range
    whole = Window.partitionBy()
    firsts = firsts.select(
        "key",
        F.coalesce(F.lag("range").over(in_order), F.max("range").over(whole)).alias("range"),
    )
    follow = (
        docs.drop("range")
        .join(F.broadcast(firsts), "key")  # one row per range
        .groupBy("range")
        .agg(F.min("text").alias("text"))
        .select(
            F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("key"), "text",
            "range", F.lit(True).alias("follows"),
        )
    )
    return docs.withColumn("follows", F.lit(False)).unionByName(follow)


def by_id() -> WindowSpec:
    """Order of the rows of a range; the one that follows the range comes last."""
    return Window.partitionBy("range").orderBy("follows", "key", "text")


def edited_fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, and their likenesses.

    The edit replaces the last quarter by the beginning of the next document.
    """
    length = F.char_length("text")
    quarter = F.floor(length / 4).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), length - quarter),
        F.substring(F.col("_next_text"), F.lit(1), quarter),
    )
    rows = (
        in_ranges(documents)
        .withColumn("_next_text", F.lead("text").over(by_id()))
        .withColumn("fingerprint", fingerprint(F.col("text")))
        .withColumn("_next", F.lead("fingerprint").over(by_id()))
        .filter(~F.col("follows"))
        .select("doc_id", length.cast("long").alias("n_chars"), "fingerprint", "_next",
                edited.alias("_edited"))
    )
    own, changed = F.col("fingerprint"), F.col("edited_fingerprint")
    return rows.select(
        "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), "fingerprint",
        fingerprint(F.col("_edited")).alias("edited_fingerprint"), "_next",
    ).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(own, changed).alias("near_edited"),
        likeness(own, F.col("_next")).alias("near_next"),
        changed_sections(own, changed).cast("long").alias("changed_sections"),
        changed_paragraphs(own, changed).cast("long").alias("changed_paragraphs"),
    )
