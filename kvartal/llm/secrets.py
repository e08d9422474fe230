"""Secret scan: candidates by patterns, false positives removed by a random forest.

Candidates are values given to a secret-like name (of any length
and any marks after a sign, else of eight characters or more), long runs of key characters with a digit,
and private-key heads. The forest judges each by its length, character transitions (against
those of the documents' own words), cover by the documents' frequent words, path and neighbouring
words; transitions and frequent words are counted over all documents. It is trained on labelled findings: a table of findings with a label, or by default
findings made from snippets of the documents (bounded), each in several true and false forms.

SQL functions only, with Spark's own forest. Texts are not shuffled; only documents with a
candidate go beyond the first look, and offsets are sums over a document's candidates.

Defined results: a null or empty text has no findings; a null path is an empty one; repeated
rows have their findings each; without documents to train on, all candidates are kept with a
null score; columns of other names are not read.
"""

from __future__ import annotations

from math import log

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window, functions as F

from kvartal.sources.staging import stage

#: fixed values: names whose values are secrets
NAMES = (
    "password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key",
    "auth_key", "private_key", "client_secret", "bearer", "credential",
)
_NAME = "(?:" + "|".join(NAMES).replace("_", "[_-]?") + ")"
_VALUE = r"[A-Za-z0-9+/_-]"
#: any characters but blanks and quotes, without the closing marks of a sentence or a bracket
_RUN = r"[^\s\"'`]*[^\s\"'`.,;:)\]}>]"
_AFTER_NAME = r"[A-Za-z0-9_-]*+[\"']?"
_SIGN = r"[ \t]*+(?:=>|:=|[:=])[ \t]*+[\"'`]?"


def _given(group: str) -> str:
    """A name with its value: after a sign, after blanks, or in the same run as the name."""
    return (
        rf"(?i:{_NAME})(?:{_AFTER_NAME}{_SIGN}{group}{_RUN})"
        rf"|{_AFTER_NAME}[ \t]++[\"'`]?(?=[^\s\"'`]{{8}}){group}{_RUN})"
        rf"|[\"']?[ \t]{{0,3}}[\"'`]?(?=[^ \t]{{8}}){group}{_VALUE}{{8,}}+={{0,2}}))"
    )


#: name and value; bare value; key head
GIVEN = _given("(?:")
BARE = rf"(?<!{_VALUE})(?=[A-Za-z+/_-]*+[0-9]){_VALUE}{{20,}}+={{0,2}}"
HEAD = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
CANDIDATE = f"{HEAD}|{GIVEN}|{BARE}"
NEAR = 60

#: snippets that findings for training are made from, and words of the dictionary, at most
SNIPPETS = 400
DICTIONARY = 500
TREES, DEPTH, SEED = 30, 6, 11
LEAST_SCORE = 0.5

_LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"
_SIDE = len(_LETTERS) + 1
FEATURES = (
    "length", "digits", "uppers", "hexes", "marks", "distinct", "entropy", "turns", "vowels",
    "transitions", "covered", "given", "named", "quoted", "told_harmless", "path_harmless",
    "path_depth", "repeats",
)


# ---------------------------------------------------------------- candidates


def findings(documents: DataFrame, path: str = "source") -> DataFrame:
    """doc_id, path, start, end (code points of the value), value, before, after: all candidates."""
    rows = documents.filter(F.col("text").rlike(CANDIDATE)).select(
        "doc_id", F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), "text",
        F.monotonically_increasing_id().alias("row"),
    )
    # what is left after the last candidate matches too, else it would be searched again and again
    whole = F.lit(f"(?s)(.*?)(?:({CANDIDATE})(?=(.{{0,{NEAR}}}))|\\z)")
    part = lambda group: F.regexp_extract_all("text", whole, F.lit(group))
    exploded = rows.select(
        "doc_id", "path", "row",
        F.posexplode(F.arrays_zip(
            F.transform(part(1), lambda gap: F.struct(
                F.char_length(gap).alias("length"), F.right(gap, F.lit(NEAR)).alias("before")
            )).alias("gap"),
            part(2).alias("found"), part(3).alias("after"),
        )).alias("at", "f"),
    ).select("doc_id", "path", "row", "at", "f.gap", "f.found", "f.after").filter("found <> ''")
    value = F.when(F.col("found").startswith("-----"), F.col("found")).otherwise(
        F.coalesce(*(
            F.nullif(F.regexp_extract("found", f"^{_given('(')}$", i), F.lit("")) for i in (1, 2, 3)
        ), F.col("found"))
    )
    so_far = Window.partitionBy("row").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap.length") + F.char_length("found")).over(so_far)
    return exploded.withColumn("end", end).withColumn("value", value).select(
        "doc_id", "path", (F.col("end") - F.char_length("value")).cast("long").alias("start"),
        F.col("end").cast("long").alias("end"), "value",
        F.concat(
            F.col("gap.before"),
            F.expr("left(found, char_length(found) - char_length(value))"),
        ).alias("before"),
        "after",
    )


# ---------------------------------------------------------------- features


def _share(value: Column, pattern: str) -> Column:
    """Part of the characters that the pattern matches."""
    return 1 - F.char_length(F.regexp_replace(value, pattern, "")) / F.greatest(
        F.char_length(value), F.lit(1)
    )


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("double")


def _pair_code(lower: Column, at: Column) -> Column:
    """Number of a transition; characters that are no letter or digit share one place."""
    place = lambda i: F.instr(F.lit(_LETTERS), F.substring(lower, i, F.lit(1)))
    return place(at) * _SIDE + place(at + 1)


def _entropy(value: Column) -> Column:
    n = F.greatest(F.char_length(value), F.lit(1))
    return F.aggregate(
        F.array_distinct(F.split(value, "")), F.lit(0.0),
        lambda total, c: total - F.when(
            c != "", ((n - F.char_length(F.replace(value, c, F.lit("")))) / n)
            * F.log2(F.greatest(n - F.char_length(F.replace(value, c, F.lit(""))), F.lit(1)) / n),
        ).otherwise(0.0),
    )


def with_features(found: DataFrame, transitions: list[float], dictionary: list[str]) -> DataFrame:
    """Findings with one column per feature."""
    value, before, path = F.col("value"), F.col("before"), F.col("path")
    lower, n = F.lower(value), F.greatest(F.char_length(value), F.lit(1))
    table = F.split(F.lit(",".join(f"{x:.4f}" for x in transitions)), ",").cast("array<double>")
    ways = F.when(n > 1, F.sequence(F.lit(1), n - 1)).otherwise(F.array().cast("array<int>"))
    likely = F.aggregate(
        ways, F.lit(0.0), lambda total, i: total + F.get(table, _pair_code(lower, i))
    ) / n
    words = "|".join(sorted(dictionary, key=lambda w: (-len(w), w)))
    harmless = r"(?i)\b(example|sample|dummy|commit|sha[0-9]*|md5|hash|checksum|digest|uuid|guid|revision)\b"
    columns = {
        "length": n.cast("double"),
        "digits": _share(value, "[0-9]"),
        "uppers": _share(value, "[A-Z]"),
        "hexes": _share(value, "[0-9a-fA-F]"),
        "marks": _share(value, "[^0-9A-Za-z]"),
        "distinct": F.size(F.array_distinct(F.split(value, ""))) / n,
        "entropy": _entropy(value),
        "turns": F.size(F.regexp_extract_all(value, F.lit("([0-9]+|[A-Z]+|[a-z]+)"), 1)) / n,
        "vowels": _share(value, "[aeiouAEIOU]"),
        "transitions": likely,
        "covered": _share(lower, f"(?:{words})") if words else F.lit(0.0),
        "given": _flag(before.rlike(r"[:=]>?[ \t]*[\"'`]?$")),
        "named": _flag(before.rlike(rf"(?i){_NAME}(?:[^A-Za-z0-9]{{0,8}}|{_AFTER_NAME}(?:{_SIGN}|[ \t]*+[\"'`]?))$")),
        "quoted": _flag(before.rlike("[\"'`]$")),
        "told_harmless": _flag(before.rlike(harmless) | F.col("after").rlike(harmless)),
        "path_harmless": _flag(path.rlike(r"(?i)(test|example|sample|fixture|mock|docs?)([/._-]|$)")),
        "path_depth": (F.char_length(path) - F.char_length(F.replace(path, F.lit("/"), F.lit("")))).cast("double"),
        "repeats": _share(value, r"(.)(?=\1\1)"),
    }
    return found.select("*", *(c.cast("double").alias(name) for name, c in columns.items()))


# ---------------------------------------------------------------- training


def snippets_of(documents: DataFrame, most: int = SNIPPETS) -> DataFrame:
    """At most so many short cuts from anywhere in the documents, the same in every run, stored."""
    h = F.xxhash64("doc_id", "text")
    start = F.pmod(h, F.greatest(F.char_length("text") - 400, F.lit(1))).cast("int") + 1
    return stage(
        documents.filter(F.char_length("text") > 0)
        .select(h.alias("h"), F.substring(F.col("text"), start, F.lit(400)).alias("snippet"))
        .orderBy("h", "snippet")
        .limit(most)
        .coalesce(1),
        "secret-snippets",
    )


def language_of(texts: DataFrame, column: str = "snippet") -> tuple[list[float], list[str]]:
    """Log chance of every transition inside words, and the frequent words, of all the texts."""
    words = stage(
        texts.select(F.explode(F.regexp_extract_all(F.lower(column), F.lit("[a-z]{2,}"), 0)).alias("word"))
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")),
        "secret-words",
    )
    pair = F.explode(F.regexp_extract_all("word", F.lit("(?=([a-z]{2}))."), 1)).alias("pair")
    pairs = {
        row.code: row.n
        for row in words.select("n", pair).groupBy("pair").agg(F.sum("n").alias("n"))
        .select(_pair_code(F.col("pair"), F.lit(1)).alias("code"), "n")
        .collect()  # at most one row per transition
    }
    table = [
        log((pairs.get(a * _SIDE + b, 0) + 0.1) / (sum(pairs.get(a * _SIDE + c, 0) for c in range(_SIDE)) + 0.1 * _SIDE))
        for a in range(_SIDE) for b in range(_SIDE)
    ]
    frequent = (
        words.filter(F.char_length("word").between(3, 20))
        .orderBy(F.desc("n"), "word").limit(DICTIONARY)
        .collect()  # bounded
    )
    return table, [row.word for row in frequent]


def made_findings(snippets: DataFrame) -> DataFrame:
    """path, before, value, after, label: true and false findings around every snippet."""
    s, h = F.col("snippet"), F.col("h").cast("string")
    words = F.filter(F.regexp_extract_all(s, F.lit("[A-Za-z]{2,}"), 0), lambda w: w != "")
    joined = lambda by: F.substring(F.array_join(F.slice(words, 3, 6), by), 1, 40)
    random = lambda salt: F.sha2(F.concat(h, F.lit(salt)), 256)
    mixed_case = F.regexp_replace(F.base64(F.unhex(random("m"))), "[=\n]", "")
    left, right = F.substring(s, 1, 50), F.substring(s, 60, NEAR)
    name = F.get(F.array(*map(F.lit, NAMES)), F.pmod(F.col("h"), F.lit(len(NAMES))).cast("int"))
    other = F.get(F.array(*map(F.lit, ("commit", "checksum", "sha256", "md5", "uuid"))),
                  F.pmod(F.col("h"), F.lit(5)).cast("int"))
    at = F.concat(F.lit("src/"), F.lit("app/"), h)
    test_path = F.concat(F.lit("tests/fixtures/"), h)
    say = lambda *parts: F.concat(left, *(F.lit(p) if isinstance(p, str) else p for p in parts))
    forms: list[tuple[Column, Column, Column, float]] = [
        (at, say(" ", name, ' = "'), F.substring(random("a"), 1, 40), 1.0),
        (at, say(" ", name, "="), F.substring(random("b"), 1, 18), 1.0),
        (at, say(" ", name, ": '"), F.substring(mixed_case, 1, 32), 1.0),
        (at, say(" "), F.concat(F.lit("AKIA"), F.upper(F.substring(random("c"), 1, 16))), 1.0),
        (at, say(" "), F.concat(F.lit("ghp_"), F.substring(mixed_case, 1, 36)), 1.0),
        (F.lit(""), say(" ", name, " "), F.substring(random("d"), 1, 32), 1.0),
        (at, say(" ", name, ": "), F.concat(
            F.initcap(F.substring(joined(""), 1, 4)), F.lit("@"), F.substring(random("h"), 1, 4), F.lit("-2024")
        ), 1.0),
        (at, say(" ", name, "_prod = '"), F.concat(
            F.substring(mixed_case, 1, 6), F.lit("!"), F.substring(random("i"), 1, 5)
        ), 1.0),
        (F.lit(""), say(" ", F.upper(name), "_KEY="), F.substring(random("j"), 1, 14), 1.0),
        (at, say(" ", name, '      = "'), F.concat(F.substring(joined(""), 1, 5), F.substring(random("k"), 1, 4)), 1.0),
        (F.lit(""), say(" ", name, ": "), F.get(words, F.lit(3)), 0.0),
        (at, say(" ", name, " = "), F.concat(joined("_"), F.lit("("), F.get(words, F.lit(4))), 0.0),
        (at, say(" ", name, "="), F.concat(F.lit("${"), F.upper(joined("_"))), 0.0),
        (at, say(" ", name, ' = "'), F.concat(F.lit(""), joined("")), 0.0),
        (at, say(" ", name, "="), joined("_"), 0.0),
        (test_path, say(" ", name, '="'), F.concat(F.lit("example-"), joined("-")), 0.0),
        (at, say(" ", name, "="), F.repeat(F.substring(random("e"), 1, 1), 16), 0.0),
        (at, say(" ", other, " "), F.substring(random("f"), 1, 40), 0.0),
        (F.lit(""), say(" ", other, ": "), F.substring(random("g"), 1, 64), 0.0),
        (at, say(" "), F.concat(joined("/"), F.lit("/"), F.substring(h, 1, 4)), 0.0),
        (F.lit(""), say(" "), F.concat(joined(""), F.substring(h, 1, 2)), 0.0),
        (F.lit(""), say(" "), F.concat(F.lit("2024"), F.lpad(F.abs(F.col("h")).cast("string"), 18, "0")), 0.0),
    ]
    made = F.explode(F.array(*(
        F.struct(p.alias("path"), b.alias("before"), v.alias("value"), right.alias("after"),
                 F.lit(label).alias("label"))
        for p, b, v, label in forms
    )))
    return snippets.select(made.alias("f")).select("f.*").filter(F.char_length("value") > 0)


def train(labelled: DataFrame, transitions: list[float], dictionary: list[str]) -> RandomForestClassificationModel | None:
    """A forest from findings with a label (0 or 1); None without both labels."""
    rows = stage(
        with_features(labelled, transitions, dictionary).select("label", *FEATURES).coalesce(1),
        "labelled-findings",
    )
    if rows.select("label").distinct().count() < 2:
        return None
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    return RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=4
    ).fit(assembled.select("label", "features"))


def judged(found: DataFrame, model: RandomForestClassificationModel | None) -> DataFrame:
    """Findings with features, with score and kept."""
    if model is None:
        return found.withColumn("score", F.lit(None).cast("double")).withColumn("kept", F.lit(True))
    assembled = VectorAssembler(inputCols=list(FEATURES), outputCol="_features").transform(found)
    scored = model.setFeaturesCol("_features").setProbabilityCol("_chance").setRawPredictionCol("").setPredictionCol("").transform(assembled)
    return scored.withColumn("score", vector_to_array("_chance")[1]).withColumn(
        "kept", F.col("score") >= LEAST_SCORE
    )


# ---------------------------------------------------------------- operator


def secret_findings(documents: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """doc_id, start, end, value_sha256, score, kept of every candidate; training runs at once."""
    documents = documents.select("doc_id", "text", "source")
    snippets = snippets_of(documents)
    transitions, dictionary = language_of(documents, "text")
    model = train(made_findings(snippets) if labelled is None else labelled, transitions, dictionary)
    found = with_features(findings(documents), transitions, dictionary)
    return judged(found, model).select(
        "doc_id", "start", "end", F.sha2("value", 256).alias("value_sha256"),
        F.round("score", 6).alias("score"), "kept",
    )
