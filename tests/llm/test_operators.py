"""Operators without SQL against plain Python, over given tables and odd rows."""

import io
import re
import zlib
from collections import Counter
from contextlib import contextmanager, redirect_stdout

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from kvartal.llm import chats, mixing, neardup, packing, pii, quality, secrets, tokenfile, tokens, warc
from kvartal.llm.frames import table
from kvartal.llm.queries import QUERIES
from tests.llm import plain

WORDS, BYTES = "word_bpe_49k.json", "byte_bpe_50k.json"


def write(df, folder, name):
    df.coalesce(2).write.parquet(f"{folder}/{name}.parquet")


@contextmanager
def small_broadcasts(spark):
    """Only what is told to be, or is a few rows, is broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "2k")
    yield
    spark.conf.set(name, before)


def shuffled(df):
    """The plan's lines that tell what is shuffled, with their columns."""
    told = io.StringIO()
    with redirect_stdout(told):
        df.explain("formatted")
    return re.findall(r"\(\d+\) Exchange\n(Input \[\d+\]: .*)", told.getvalue())


@pytest.fixture(params=["given", "odd", "empty"])
def sf(request, spark, sf_dir, folder):
    """Folder of documents and labels."""
    if request.param == "given":
        return sf_dir
    odd = plain.odd_documents(spark).limit(0 if request.param == "empty" else 100)
    write(odd, folder, "documents")
    labels = spark.createDataFrame([(1, 1, 0), (15, 0, 0), (None, 1, None)], "doc_id long, quality long, toxic long")
    write(labels.limit(0 if request.param == "empty" else 9), folder, "labels")
    return folder


def texts(spark, sf):
    return [(row.doc_id, row.text) for row in table(spark, sf, "documents").select("doc_id", "text").collect()]


def ids_of(name, text, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_quality(spark, sf):
    found = QUERIES["op9_quality_rules"](spark, sf).collect()
    expected = Counter((i, *plain.base_counts(t)) for i, t in texts(spark, sf))
    assert Counter((*r[:6], r.base_failed) for r in found) == expected
    assert all(not r.kept for r in found if r.base_failed)


def test_quality_verdict_on_held_out_labels(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")  # the smallest has a handful of bad documents
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    rows = [(quality.statistics(r.text, quality.WordHashes()), r.quality) for r in docs.orderBy("doc_id").collect()]
    features = np.array([r[0][5:] for r in rows], float)
    good = np.array([r[1] for r in rows], float)
    half = len(rows) // 2
    trees = quality.fit_trees(features[:half], good[:half], list(quality.FEATURES.values()))
    assert ((trees.chance(features[half:]) >= quality.LEAST_CHANCE) == good[half:]).mean() > 0.9


def test_personal_data(spark, sf):
    found = {(r.doc_id, r.base_sha256): r for r in QUERIES["op6_personal_data"](spark, sf).collect()}
    for doc_id, text in texts(spark, sf):
        base = plain.base_spans(text)
        row = found[doc_id, plain.sha(plain.told(base))]
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(
            sum(k == kind for k, _, _ in base) for kind in pii.KINDS
        )
        assert set(plain.told(base).split(",")) - {""} <= set(row.spans.split(","))


def test_masked(spark, folder):
    docs = plain.odd_documents(spark)
    found = pii.masked(docs).filter("doc_id = 12").collect()
    assert [r.text for r in found] == ["mail me at [EMAIL] or [PHONE], [IP]"]
    assert found[0].n_chars == len(found[0].text)
    assert pii.masked(docs).columns == docs.columns


def test_packing(spark, sf):
    found = [r.asDict() for r in QUERIES["op7_packing"](spark, sf).collect()]
    by_sequence, by_doc = {}, {}
    for r in found:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"], r["ids_crc32"]))
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= packing.LENGTH
    copies = Counter((i, t) for i, t in texts(spark, sf))
    seen = 0
    for (doc_id, text), n in copies.items():
        ids = ids_of(WORDS, text, packing.END_ID)
        pieces = by_doc[doc_id, len(ids)]
        own = [(s, k, c) for s, k, c in pieces if c == crc(ids[s : s + k])]
        assert Counter(i for s, k, _ in own for i in range(s, s + k)) == Counter(dict.fromkeys(range(len(ids)), n))
        seen += len(own)
    assert seen == len(found)


def test_token_files(spark, sf):
    found = [tuple(r) for r in QUERIES["op8_token_files"](spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    expected, start = [], 0
    for doc_id, text in sorted(texts(spark, sf), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = ids_of(BYTES, text, tokenfile.END_ID)
        expected.append((doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert Counter(found) == Counter(expected)


def test_token_look_up(spark, folder):
    docs = plain.odd_documents(spark)
    encoder = tokens.byte_tokens(public_tokenizers.path(BYTES))
    foreign = np.arange(10**6, 10**6 + 5000)
    seeds, slots, prints = tokenfile.build_index(foreign, foreign * 0)
    by_slot = np.argsort(slots)

    class Shard:
        pass

    shard = Shard()
    shard.seeds, shard.fingerprints = seeds.astype("<u4").tobytes(), (prints * 0)[by_slot].astype("<u4").tobytes()
    shard.offsets = shard.lengths = np.zeros(5000, "<i8").tobytes()
    shard.keys = np.stack([foreign, foreign * 0])[:, by_slot].astype("<i8").tobytes()
    assert not tokenfile.find(shard, foreign + 7000, foreign * 0)[0].any()
    tokenfile.write_shards(docs.select("doc_id", "text"), encoder, f"{folder}/ids", shard_ids=50)
    asked = spark.createDataFrame(
        [(8, 0), (8, 1), (8, 2), (3, 0), (11, 0), (99, 0), (-1, 0)], "doc_id long, occurrence long"
    )
    found = {(r.doc_id, r.occurrence): r.ids for r in tokenfile.look_up(spark, f"{folder}/ids", asked).collect()}
    by_id = dict(texts_of(docs))
    assert found == {
        key: ids_of(BYTES, by_id[key[0]], 0) for key in ((8, 0), (8, 1), (3, 0), (11, 0))
    }


def texts_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_near_duplicate_hubs_settle_large_buckets(spark):
    """A star, a chain and strangers, with hub rounds that list few pairs."""
    base = plain.prose(1, 200).split()

    def copy(i, n=5):
        own = base.copy()
        for k in range(n):
            own[(i * 37 + k * 41) % 200] = f"x{i}y{k}"
        return " ".join(own)

    chain, chained = plain.prose(9, 150).split(), []
    for i in range(12):
        chain = chain[4:] + [f"c{i}d{j}" for j in range(4)]
        chained.append(" ".join(chain))
    rows = [(0, " ".join(base)), *((i, copy(i, 2)) for i in range(1, 60)),
            *((100 + i, text) for i, text in enumerate(chained)), *((200 + i, plain.prose(20 + i, 100)) for i in range(9))]
    found = {r.doc_id: r.component_id for r in neardup.duplicate_groups(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ).collect()}
    smallest, _ = plain.groups([plain.shingles(t) for _, t in rows], [i for i, _ in rows])
    assert found == {i: c for (i, _), c in zip(rows, smallest, strict=True)}


def test_members_near_the_threshold_are_few_pairs(spark, monkeypatch):
    """Likeness of 0.72 survives every signature, but only similar pairs that join components are rows."""
    counts, stage = [], neardup.stage

    def counted(df, label):
        stored = stage(df, label)
        counts.extend([stored.count()] if label == "pairs" else [])
        return stored

    monkeypatch.setattr(neardup, "stage", counted)
    passage = " ".join(f"p{k}" for k in range(150))
    own = lambda i, n=28: " ".join(f"w{i}q{k}" for k in range(n))
    rows = [(i, f"{passage} {own(i)}") for i in range(70)]
    rows += [(100 + i, f"{passage} {own(i // 3)} x{i} y{i}") for i in range(30)]
    found = {r.doc_id: r.component_id for r in neardup.duplicate_groups(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ).collect()}
    smallest, _ = plain.groups([plain.shingles(t) for _, t in rows], [i for i, _ in rows])
    assert found == {i: c for (i, _), c in zip(rows, smallest, strict=True)}
    assert len(set(smallest)) == 70 and counts[-1] < len(rows)


def test_joining_pairs():
    """One pair for every join of components; all surviving pairs of a member without its set."""
    passage = plain.prose(1, 150)
    texts = [f"{passage} a{i} b{i}" for i in range(8)] + [f"{passage} {plain.prose(9, 28)}", "w " + plain.prose(5, 100)]
    frame = pd.DataFrame({"row": range(len(texts)), "text": texts})
    sets = next(neardup._shingle_sets(iter([frame])))
    long = next(neardup._long_signatures(iter([frame])))["long"]
    mark = neardup._marks_and_values(pd.DataFrame({"long": long}))[0]
    assert (mark[0] == mark[1]).any()
    bucket = int(mark[0][np.flatnonzero((mark[:8] == mark[0]).all(axis=0))[0]])
    block = sets.assign(
        long=long, bucket=bucket, block=0, beside=-1, component=frame["row"], first=frame["row"] < 9
    )
    parents = {}
    found = list(neardup._joining_pairs(block, parents))
    assert len(found) == len(parents) and {i for pair in found for i in pair} <= set(range(9))
    told = {frozenset((i, int(j))) for i, others in neardup._told_here(block) for j in others}
    assert len(told) > len(found) > 0
    assert list(neardup._joining_pairs(block, parents)) == []
    without = {frozenset(pair) for pair in neardup._joining_pairs(block.assign(shingles=None), {})}
    assert without == told


def test_blocks_of_strangers_meet_in_pairs(spark, monkeypatch):
    """Documents around one passage are no near copies; few of them are held at a time."""
    monkeypatch.setattr(neardup, "BLOCK", 16)
    held = []
    dealt = neardup._dealt
    monkeypatch.setattr(neardup, "_dealt", lambda rest: held.append((rest, dealt(rest))) or held[-1][1])
    passage, other = plain.prose(1, 150), plain.prose(2, 120)
    rows = [(i, f"{passage} {plain.prose(100 + i // 2, 54)} {'a b' if i % 2 else 'c'}") for i in range(160)]
    rows += [(300 + i, f"{other} x{i} y{i}") for i in range(60)]
    found = {r.doc_id: r.component_id for r in neardup.duplicate_groups(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    ).collect()}
    smallest, _ = plain.groups([plain.shingles(t) for _, t in rows], [i for i, _ in rows])
    assert found == {i: c for (i, _), c in zip(rows, smallest, strict=True)}
    rest, pairs = held[0]
    most = lambda frame, *by: frame.groupBy(*by).count().agg(F.max("count")).first()[0]
    assert most(rest, "bucket") > 100
    assert most(pairs, "bucket", "block", "beside") < 80
    one, two = (pairs.select("bucket", "block", "beside", F.col("row").alias(n), F.col("first").alias(f"f_{n}")) for n in "ab")
    met = one.join(two, ["bucket", "block", "beside"]).filter(
        "a <> b AND f_a AND (NOT f_b OR (beside = -1 AND b > a))"
    ).groupBy("bucket", F.least("a", "b"), F.greatest("a", "b")).count()
    outside = rest.groupBy("bucket").agg(F.count_if(~F.col("main")).alias("o"), F.count_if("main").alias("m"))
    assert met.filter("count > 1").count() == 0
    assert met.count() == outside.agg(F.sum(F.expr("cast(o * m + o * (o - 1) / 2 as long)"))).first()[0]


def test_marked_rows(spark, monkeypatch):
    """Rows found by their bits are those of a join, of a table that is not shuffled."""
    rows = [(i << 33 | k, f"{i} {k}") for i in (0, 1, 9) for k in (0, 1, 2, 7, 8, 32767, 32768, 32769, 99999)]
    stored = spark.createDataFrame(rows, "row long, text string")
    ids = spark.createDataFrame([(n,) for n, _ in rows[::2]], "row long")
    with small_broadcasts(spark):
        found = neardup._of_marked(stored, ids)
        assert not shuffled(found)
        assert sorted(map(tuple, found.collect())) == sorted(rows[::2])
        assert not neardup._of_marked(stored, ids.limit(0)).count()
        monkeypatch.setattr(neardup, "BITMAPS", 0)
        assert sorted(map(tuple, neardup._of_marked(stored, ids).collect())) == sorted(rows[::2])


def test_one_of_each(spark):
    docs = plain.odd_documents(spark)
    rows = docs.collect()
    kept = neardup.one_of_each(docs).collect()
    _, group = plain.groups([plain.shingles(r.text) for r in rows], [r.doc_id for r in rows])
    assert len(kept) == len({g if plain.shingles(r.text) else (n, "alone") for n, (g, r) in enumerate(zip(group, rows, strict=True))})
    assert neardup.one_of_each(docs).columns == docs.columns
    assert neardup.one_of_each(docs.limit(0)).count() == 0


def test_mixed_documents(spark):
    docs = plain.odd_documents(spark)
    found = mixing.mixed_documents(docs)
    assert found.columns == docs.columns
    taken = {}
    for r in mixing.words_taken(mixing.mix(docs)).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    words = Counter()
    for r in found.collect():
        words[r.doc_id] += len(plain.words(r.text))
        assert r.n_chars == len(r.text)
    assert words == Counter({k: v for k, v in taken.items() if v})
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_mixed_texts_are_shuffled_once(spark):
    """Cut documents are told before their texts are read."""
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "repeat(concat('w', id, ' '), 20 + cast(id % 90 AS int)) AS text", "concat('s', id % 3) AS source"
    )
    with small_broadcasts(spark):
        moved = shuffled(mixing.mixed_documents(docs))
    assert sum("text#" in line for line in moved) == 1


def test_schedule_follows_its_points(spark, monkeypatch):
    """In any stretch every source stands in nearly its share; other points give another schedule."""
    docs = spark.createDataFrame(
        [(i, plain.prose(i, 300), "abc"[i % 3]) for i in range(600)], "doc_id long, text string, source string"
    )
    mixed = mixing.mix(docs, block=64)
    rows = mixed.plan.select("slot", "source_no").distinct().collect()
    shares = Counter(r.source_no for r in rows)
    for size in (50, 200, 800):
        for start in range(0, len(rows) - size, size):
            here = Counter(r.source_no for r in rows if start <= r.slot < start + size)
            assert all(abs(here[n] / size - shares[n] / len(rows)) < 6 / size for n in shares)
    told = lambda: sorted(map(tuple, mixing.words_taken(mixing.mix(docs, block=64)).collect()))
    before = told()
    monkeypatch.setattr(mixing, "golden_point", lambda slot: slot * 0)
    after = told()
    assert before != after and [r[:5] for r in before] == [r[:5] for r in after]


def _conversations(spark):
    rows, rng = [], np.random.default_rng(3)
    for i in range(60):
        path = [int(x) for x in rng.integers(0, 2, rng.integers(1, 6))]
        rows += [(i, t, "user" if t % 2 == 0 else "assistant", f"turn {path[: t + 1]} " + "w " * (20 * t)) for t in range(len(path))]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_forest_layout(spark):
    """Streams, positions and ancestors by a plain form."""
    turns = _conversations(spark)
    forest = chats.build_forest(turns)
    paths = {}
    for r in sorted(turns.collect(), key=lambda r: (r.conv_id, r.turn)):
        paths.setdefault(r.conv_id, []).append(chats.format_turn(r.role, r.text)[0])
    prefixes = {tuple(p[:n]) for p in paths.values() for n in range(1, len(p) + 1)}
    nodes = forest.nodes.collect()
    assert len(nodes) == len(prefixes)  # each shared turn once
    streams = {}
    for n in sorted(nodes, key=lambda n: (n.tree, n.start)):
        stream = streams.setdefault(n.tree, [])
        assert n.start == sum(len(x.formatted) for x in stream)
        stream.append(n)
    found = set()
    for n in nodes:
        path = paths[n.cid][: n.idx + 1]
        assert path[-1] == n.formatted and n.position == sum(map(len, path[:-1]))
        found.add(tuple(path))
    assert found == prefixes
    for s in forest.segments.collect():
        read = [
            n for a in s.attention for n in streams[s.tree] if a.start <= n.start < a.end
        ]
        assert [n.formatted for n in sorted(read, key=lambda n: n.position)] == paths[s.cid]
        assert [n.position for n in read] == sorted(n.position for n in read)
        assert sum(a.end - a.start for a in s.attention) == sum(map(len, paths[s.cid]))
    # depth-first: a branch ends before another branch of an earlier turn begins
    for stream in streams.values():
        seen, here = set(), ()
        for n in stream:
            path = tuple(paths[n.cid][: n.idx + 1])
            common = next((k for k, (x, y) in enumerate(zip(here, path)) if x != y), min(len(here), len(path)))
            assert path[:-1] == path[: len(path) - 1] and (len(path) == 1 or path[:-1] in seen)
            assert common >= len(path) - 1 or path[:-1] in seen
            seen.add(path)
            here = path


def test_conversations_are_read_by_place(spark):
    """Without true starts or positions nothing true comes back."""
    forest = chats.build_forest(_conversations(spark))
    told = lambda f: Counter(map(tuple, chats.read_conversations(f).collect()))
    right = told(forest)
    assert len(right) == 60
    zero = F.lit(0).cast("long")
    assert told(chats.Forest(forest.nodes.withColumn("start", zero), forest.segments)) != right
    assert told(chats.Forest(forest.nodes.withColumn("position", -F.col("position")), forest.segments)) != right
    ends = F.transform("attention", lambda a: F.struct(a.start.alias("start"), a.start.alias("end")))
    assert told(chats.Forest(forest.nodes, forest.segments.withColumn("attention", ends))) != right


def test_warc(spark, sf_dir, folder):
    page = (
        '<!DOCTYPE html><html lang="fr"><head><title>A &amp; B</title><style>p{}</style><script>"<p>no</p>"</script>'
        '</head><body><a class="x" href="/a?b=1&amp;c#top">one</a><!-- <a href="/no">x</a> --><p>t&eacute;xt <b>bo</b>ld</p>'
        "<img src='i.png'><a href=//o.example/z>two</a><a data-x=' href=\"/fake\"'>3</a></body></html>"
    )
    rows = [(1, "https://e.example/d/", page, 5), (2, None, None, 5), (3, "https://e.example/", "<a " + "x" * 100_000, 5),
            (None, "u", "<p>only", 5), (1, "https://e.example/d/", page, 5)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_id int")
    records = warc.derive(warc.responses(pages))
    sources = {r.record_id: r for r in warc.responses(pages).collect()}
    found = records.collect()
    assert len(found) == 10
    for r in found:
        source = sources[r.refers_to]
        assert r.payload_digest == source.payload_digest and r.target_uri == source.target_uri
        assert r.block_digest == warc.digest(r.block.encode()) and r.content_length == len(r.block.encode())
    one = {r.record_type: r for r in found if r.page_id == 1}
    assert one["conversion"].block == "one\ntéxt bold\ntwo3"  # the title is metadata
    assert "title: A & B\r\n" in one["metadata"].block and "source-content-type: text/html" in one["metadata"].block
    assert [line for line in one["metadata"].block.split("\r\n") if line.startswith("outlink")] == [
        "outlink: https://e.example/a?b=1&c a/@href", "outlink: https://e.example/d/i.png img/@src",
        "outlink: https://o.example/z a/@href",
    ]
    assert f"WARC-Concurrent-To: {one['conversion'].record_id}" in one["metadata"].header
    for compression in ("none", "gzip"):
        warc.write_warc(records, f"{folder}/{compression}", compression)
        back = warc.read_warc(spark, f"{folder}/{compression}").collect()
        assert Counter((r.record_id, r.refers_to, r.block) for r in back) == Counter(
            (r.record_id, r.refers_to, r.block) for r in found
        )
    assert QUERIES["op3_warc_derivatives"](spark, sf_dir).count() == 2 * table(spark, sf_dir, "pages").count()
    assert warc.derived_records(pages.limit(0)).count() == 0


def test_warc_fields_stay_on_their_lines(spark):
    page = '<html lang="fr&#13;&#10;outlink: x"><title>a&#10;b</title><a href="/c&#10;d">t</a>'
    pages = spark.createDataFrame([(2**53 + 1, "http://e.example/\r\nWARC-Type: x", page), (None, "u", None)],
                                  "page_id long, url string, html string")
    found = warc.derive(warc.responses(pages)).collect()
    assert Counter(r.page_id for r in found) == {2**53 + 1: 2, None: 2}
    for r in found:
        assert sum(line.startswith("WARC-Type:") for line in r.header.split("\r\n")) == 1
    block = next(r.block for r in found if r.page_id and r.record_type == "metadata")
    assert [line.split(":")[0] for line in block.splitlines()] == [
        "title", "language", "source-content-type", "source-content-length", "outlink"]


def test_warc_is_linear_on_broken_pages():
    import time

    def took(markup, n):
        start = time.process_time()
        warc.read_page(markup * n, "http://e.example/")
        return time.process_time() - start

    for markup in ("<script ", "<title ", '<a "', '<a ">" ', "<!--", "<a href='", "</p ", "<svg>", "&amp"):
        took(markup, 10)
        assert took(markup, 32_000) < 24 * min(took(markup, 4_000) for _ in range(3)) + 0.05


def test_given_pages_as_plain_rules_have_them(spark, sf_dir):
    """Titles, links and texts of the given pages, by patterns for their regular markup."""
    import html
    import re

    rows = {r.page_id: r for r in table(spark, sf_dir, "pages").collect()}
    found = warc.derive(warc.responses(table(spark, sf_dir, "pages"))).collect()
    assert len(found) == 2 * len(rows)
    for r in found:
        page = rows[r.page_id].html
        if r.record_type == "metadata":
            fields = [line.split(": ", 1) for line in r.block.split("\r\n")[:-1]]
            title = " ".join(html.unescape(re.search("<title>(.*?)</title>", page, re.S)[1]).split())
            assert [v for k, v in fields if k == "title"] == ([title] if title else [])
            links = dict.fromkeys(re.findall('<a href="([^"]*)"', page))
            assert len([k for k, _ in fields if k == "outlink"]) == len(links)
        else:
            body = re.sub(r"(?s)<!--.*?-->|<(script|style)>.*?</\1>|<title>.*?</title>", "", page)
            words = html.unescape(re.sub("<(?!/?b>)[^>]*>", " ", body).replace("<b>", "").replace("</b>", "")).split()
            assert r.block.split() == words


def test_secrets(spark, sf):
    import re

    found = QUERIES["op10_secret_scan"](spark, sf).collect()
    by_id = dict(texts(spark, sf))
    hexes = {
        (i, m.start(1), m.end(1)) for i, t in by_id.items()
        for m in re.finditer(r"(?:token = \"|password=)([0-9a-f]{16,})", t or "")
    }
    assert hexes <= {(r.doc_id, r.start, r.end) for r in found if r.kept}
    assert all(plain.sha(by_id[r.doc_id][r.start : r.end]) == r.value_sha256 for r in found)


def test_secrets_on_held_out_findings(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    snippets = secrets.snippets_of(docs)
    transitions, dictionary = secrets.language_of(snippets)
    made = secrets.made_findings(snippets)
    held = F.pmod(F.xxhash64("before"), F.lit(4)) == 0
    model = secrets.train(made.filter(~held), transitions, dictionary)
    found = secrets.judged(secrets.with_features(made.filter(held), transitions, dictionary), model)
    right = found.agg(F.avg((F.col("kept") == (F.col("label") == 1)).cast("double"))).first()[0]
    assert right > 0.95


def test_secret_candidates_of_common_settings(spark, sf_dir):
    settings = {
        "password: P@ssw0rd-2024": "P@ssw0rd-2024", "SECRET_KEY=abc123def456gh": "abc123def456gh",
        'password_prod = "hunter2hunter2"': "hunter2hunter2", 'password      =     "hunter2hunter2"': "hunter2hunter2",
        "token=abcdefgh12#$%ij9": "abcdefgh12#$%ij9", "pwd: x9!k": "x9!k", "password s3cr3t!pass.": "s3cr3t!pass",
        "'api_key': 'Zx9-aa_b',": "Zx9-aa_b", "password12345678": "12345678", "(secret=a1b2c3d4e5)": "a1b2c3d4e5",
        "run deadbeef0123456789abcdef now": "deadbeef0123456789abcdef", "token => q1w2e3r4t5": "q1w2e3r4t5",
    }
    rows = [(i, f"é some words before {text}\nand after", "src/a.py") for i, text in enumerate(settings)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = secrets.findings(docs).collect()
    assert {(r.doc_id, r.value) for r in found} == set(enumerate(settings.values()))
    assert all(rows[r.doc_id][1][r.start : r.end] == r.value for r in found)
    given = table(spark, sf_dir.replace("sf0.001", "sf0.01"), "documents").select(F.lit(100).alias("doc_id"), "text", "source")
    told = secrets.secret_findings(docs.unionByName(given)).filter("doc_id < 5").collect()
    assert sum(r.kept for r in told) >= 4


def test_secret_statistics_cover_all_documents(spark, monkeypatch):
    """Words far from any snippet, and of more documents than there are snippets, are counted."""
    rows = [(i, f"alpha w{chr(97 + i % 26)}{chr(97 + i // 26)}zz " + "beta " * 300, "s") for i in range(600)]
    rows += [(1000, "quetzal " * 20_000 + "nahuatl " * 400_000, "s"), (None, None, None)]
    told = []
    monkeypatch.setattr(secrets, "train", lambda made, *language: told.append(language))
    secrets.secret_findings(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    (transitions, dictionary), = told
    words = Counter(w for _, t, _ in rows for w in (t or "").split())
    assert dictionary == sorted(words, key=lambda w: (-words[w], w))[: secrets.DICTIONARY]
    pairs = Counter()
    for word, n in words.items():
        for pair in zip(word, word[1:]):
            pairs[pair] += n
    side, place = secrets._SIDE, lambda c: ord(c) - ord("a") + 1
    for a, b in (("n", "a"), ("t", "l"), ("q", "u"), ("z", "z"), ("b", "c")):
        after = sum(n for (x, _), n in pairs.items() if x == a)
        expected = np.log((pairs[a, b] + 0.1) / (after + 0.1 * side))
        assert transitions[place(a) * side + place(b)] == pytest.approx(expected)


def test_secret_scan_is_sql_only(spark, sf_dir):
    for name in ("op1_fingerprints", "op10_secret_scan"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_pipeline(spark, sf):
    """Every stage by a plain form on its own input, and the run's own rows."""
    docs = table(spark, sf, "documents")
    columns = docs.columns
    by_name = dict(corpus_pipeline.STAGES)
    good = by_name["quality rules"](spark, docs, sf)
    good_rows = good.collect()
    kept = Counter((r.doc_id, r.text) for r in good_rows)
    assert not any(plain.base_counts(t)[5] for _, t in kept)
    single = by_name["near duplicates"](spark, good, sf)
    smallest, group = plain.groups([plain.shingles(r.text) for r in good_rows], [r.doc_id for r in good_rows])
    assert single.count() == len(set(group))
    masked = by_name["personal data"](spark, single, sf)
    assert not any(plain.base_spans(r.text) for r in masked.collect())
    mixed = by_name["source mix"](spark, masked, sf)
    for stage in (good, single, masked, mixed):
        assert stage.columns == columns
    packed = by_name["packing"](spark, mixed, sf).collect()
    run = corpus_pipeline.run(spark, sf).collect()
    piece = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert Counter(map(piece, run)) == Counter(map(piece, packed))
    expected = Counter()
    for r in mixed.collect():
        expected[r.doc_id, len(ids_of(WORDS, r.text, packing.END_ID))] += len(ids_of(WORDS, r.text, packing.END_ID))
    total = Counter()
    for r in run:
        total[r.doc_id, r.doc_tokens] += r.length
    assert total == expected


def test_words_are_looked_for_once_between_white_space():
    encoder = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"), False)
    text = "It's a (large)\thouse, 120 m2;\r\nit's 3,500.00 'x' don't''s Ça va?\x0b\x0cЁж"
    assert encoder.of(text) == encoder.whole(text)
    seen = []
    plain_words = encoder._words
    encoder._words = lambda run: seen.append(run) or plain_words(run)
    assert encoder.of(f"{text} {text}") == encoder.whole(f"{text} {text}")
    assert not seen  # all runs are known
