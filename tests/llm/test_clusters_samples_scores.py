"""Heap-ordered bounds, importance samples and the n-gram classifier against plain forms."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from kvartal.llm import heapmeans, resampling, wordmodel
from kvartal.llm.frames import table
from kvartal.llm.queries import QUERIES
from kvartal.llm.words import WordHashes
from tests.llm import plain

# -- clusters ----------------------------------------------------------------


def plain_rounds(vectors, centroids, rounds):
    """Centroids and owners after every round, by comparing every vector with every centroid."""
    for _ in range(rounds):
        apart = ((vectors[:, None] - centroids[None]) ** 2).sum(axis=2)
        owners = apart.argmin(axis=1)
        yield centroids, owners
        centroids = np.array([
            vectors[owners == k].sum(axis=0) // (owners == k).sum() if (owners == k).any() else centroids[k]
            for k in range(len(centroids))
        ])


@given(st.integers(0, 10**6), st.integers(1, 7), st.sampled_from([3, 50, 5000]))
@settings(deadline=None, max_examples=60)
def test_heaps_give_the_exact_owners(seed, clusters, spread):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-spread, spread, (200, 4))
    first = vectors[rng.choice(200, clusters)]  # ties and equal centroids included
    owners, heaps = heapmeans.fresh_state(len(vectors), clusters)
    totals, drift, before = np.zeros((clusters, 5), np.int64), np.zeros(clusters), first
    for centroids, expected in plain_rounds(vectors, first, 8):
        drift = heapmeans.added_drift(drift, before, centroids)
        heapmeans.rescan(vectors, owners, heaps, totals, centroids, drift)
        assert (owners == expected).all()
        assert totals[:, 0].tolist() == np.bincount(expected, minlength=clusters).tolist()
        assert (totals[:, 1:] == [vectors[expected == k].sum(axis=0) for k in range(clusters)]).all()
        assert (heapmeans.moved_centroids(centroids, totals)[totals[:, 0] > 0] == [
            vectors[expected == k].sum(axis=0) // (expected == k).sum() for k in range(clusters) if (expected == k).any()
        ]).all()
        assert sorted(i for heap in heaps for _, i in heap) == list(range(200))
        before = centroids


def test_later_rounds_look_at_few_vectors():
    rng = np.random.default_rng(1)
    middles = rng.integers(-4000, 4000, (8, 16))
    vectors = (middles[rng.integers(0, 8, 4000)] + rng.normal(0, 300, (4000, 16))).astype(np.int64)
    owners, heaps = heapmeans.fresh_state(4000, 8)
    totals, drift, before, looked = np.zeros((8, 17), np.int64), np.zeros(8), vectors[:8], []
    for centroids, _ in plain_rounds(vectors, vectors[:8], 12):
        drift = heapmeans.added_drift(drift, before, centroids)
        looked.append(heapmeans.rescan(vectors, owners, heaps, totals, centroids, drift))
        before = centroids
    assert looked[0] == 4000
    assert sum(looked[6:]) < 0.2 * 4000 * len(looked[6:])


def test_state_survives_a_table(spark):
    rng = np.random.default_rng(2)
    vectors, centroids = rng.integers(-99, 99, (50, 4)), rng.integers(-99, 99, (3, 4))
    owners, heaps = heapmeans.fresh_state(50, 3)
    totals = np.zeros((3, 5), np.int64)
    heapmeans.rescan(vectors, owners, heaps, totals, centroids, np.zeros(3))
    (row,) = heapmeans._packed(7, owners, heaps, totals).to_pylist()
    again = heapmeans._unpacked(row, 3)
    assert (again[0] == owners).all() and again[1] == heaps and (again[2] == totals).all()
    assert row["heads"] == [heap[0][0] for heap in heaps]


def test_rounds_do_not_shuffle_vectors(spark, monkeypatch):
    """Blocks are cut small here: several per bucket, and a join of the two tables without an exchange."""
    monkeypatch.setattr(heapmeans, "BLOCK", 64)
    plans = []
    write = heapmeans.bucketed_tables

    def listening(session, buckets):
        scope = write(session, buckets)
        stored = scope.__enter__()

        def told(df, label):
            plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
            return stored(df, label)

        class Open:
            def __enter__(self):
                return told

            def __exit__(self, *error):
                return scope.__exit__(*error)

        return Open()

    monkeypatch.setattr(heapmeans, "bucketed_tables", listening)
    rng = np.random.default_rng(4)
    given = rng.normal(0, 1, (900, 6)).round(2)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(given)], "vec_id long, v array<double>")
    found = heapmeans.clustered(frame, "vec_id", "v", clusters=5, rounds=6, seed="3", size=6)
    rows = {r.id: (r.cluster, r.distance) for r in found.rows.collect()}
    whole = np.floor(1024 * given).astype(np.int64)
    apart = ((whole[:, None] - found.centroids[None]) ** 2).sum(axis=2)
    assert rows == {i: (int(a.argmin()), int(a.min())) for i, a in enumerate(apart)}
    rounds = [plan for label, plan in plans if label == "heaps"]
    assert len(rounds) == 7
    assert all("SortMergeJoin" in plan and "Exchange" not in plan for plan in rounds[1:])
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("kvartal_")]


def test_huge_components_and_one_cluster(spark):
    rows = [(1, [1e30, -1e30]), (2, [0.5, 0.25]), (2, [0.5, 0.25])]
    found = heapmeans.clustered(
        spark.createDataFrame(rows, "i long, v array<double>"), "i", "v", clusters=1, rounds=3, seed="3", size=2
    )
    report = heapmeans.cluster_report(found).collect()
    assert [r.cluster for r in report] == [0, 0, 0] and len({r.inertia for r in report}) == 1


# -- importance sample -------------------------------------------------------


def plain_runs(text, least, most):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]


@given(st.text(st.sampled_from("ab9 .\n\tAZ\x00é漢-'"), max_size=60), st.integers(1, 2), st.integers(2, 4))
@settings(deadline=None, max_examples=300)
def test_overlapped_scan(text, least, most):
    patterns = [resampling.run_pattern(n) for n in range(least, most + 1)]
    data = resampling.collapsed(text)
    _, expected = plain_runs(text, least, most)
    assert [data[a:b].decode() for a, b in resampling.scanned(data, patterns)] == expected
    found = dict(zip(*(x.tolist() for x in resampling.bucket_counts(data, patterns, 97))))
    assert found == Counter(zlib.crc32(run.encode()) % 97 for run in expected)


def test_sample_of_word_pairs(spark):
    """Runs of one to three words, by a plain form of the whole draw."""
    docs = plain.odd_documents(spark)
    target = spark.createDataFrame([("the river light paper the river",), (None,)], "text string")
    found = resampling.importance_sample(docs, target, percent=40, seed="s", least=1, most=3, buckets=50, least_words=5)
    rows = [(r.doc_id, *plain_runs(r.text, 1, 3)) for r in docs.collect()]
    bucket = lambda run: zlib.crc32(run.encode()) % 50
    own = Counter(bucket(run) for _, _, runs in rows for run in runs)
    wanted = Counter(bucket(run) for run in plain_runs("the river light paper the river", 1, 3)[1])
    gain = [
        math.floor(1000 * math.log((wanted[b] + 1) * (own.total() + 50) / ((own[b] + 1) * (wanted.total() + 50))))
        for b in range(50)
    ]
    scored = []
    for i, words, runs in rows:
        weight = sum(gain[bucket(run)] for run in runs) // len(runs) if runs else 0
        h = int(plain.sha(f"s:{'' if i is None else i}")[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((i, len(words), len(runs), weight, score))
    can = sorted((r for r in scored if r[1] >= 5), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    draws = len(can) * 40 // 100
    expected = [(*r, n + 1 if n < draws else None) for n, r in enumerate(can)] + [(*r, None) for r in scored if r[1] < 5]
    assert Counter(tuple(r) for r in found.collect()) == Counter(expected)


def test_sample_prefers_the_target(spark):
    rows = [(i, plain.prose(i, 60) if i % 2 else "zorro quux " * 30) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(plain.prose(i, 60),) for i in range(1, 60, 2)], "text string")
    drawn = resampling.importance_sample(docs, target, percent=20, seed="1").filter("rank IS NOT NULL").collect()
    assert sorted(r["rank"] for r in drawn) == list(range(1, 81))
    assert sum(r.doc_id % 2 for r in drawn) > 72


# -- classifier --------------------------------------------------------------


def test_scores_on_held_out_labels(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    found = QUERIES["op13_quality_classifier"](spark, sf_dir)
    assert found.count() == table(spark, sf_dir, "documents").count()
    rows = found.filter("held_out").join(table(spark, sf_dir, "labels"), "doc_id").collect()
    assert len(rows) > 50 and all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.98


def test_held_out_labels_are_not_read(spark, folder, sf_dir):
    """Turning the held-out labels round changes no score."""
    labels, docs = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    turned = labels.withColumn("quality", F.when(
        wordmodel.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert turned.exceptAll(labels).count() > 0
    one, other = (Counter(map(tuple, wordmodel.quality_scores(docs, x).collect())) for x in (labels, turned))
    assert one == other


@pytest.mark.parametrize("kind", ["odd", "no labels", "one kind", "empty"])
def test_odd_scores(spark, kind):
    docs = plain.odd_documents(spark).limit(0 if kind == "empty" else 100)
    rows = [(1, 1, 0), (15, 0, 0), (None, 1, None), (8, None, 1), (8, 1, 1), (8, 0, 1), (2, 0, 0), (2**53 + 1, 1, 1)]
    if kind == "one kind":
        rows = [(i, 1, 0) for i, _, _ in rows]
    labels = spark.createDataFrame(rows, "doc_id long, quality long, good long").limit(0 if kind == "no labels" else 99)
    found = wordmodel.quality_scores(docs, labels).collect()
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in docs.collect())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_leader_by_hand():
    """Weights after one row are the minimiser written out; later rows follow a plain dictionary form."""
    rows = [
        (np.array([0, 3, 5], "<u4"), np.array([0.5, 0.5, 0.7], "<f4")), (np.array([0, 5], "<u4"), np.array([0.6, 0.8], "<f4")),
        (np.array([0, 3], "<u4"), np.array([0.8, 0.6], "<f4")),
    ]
    good = np.array([1.0, 0.0, 1.0])
    found = wordmodel.fit(rows, good, size=8, seed=1)
    z, n, order = {}, {}, np.random.default_rng(1)

    def weight(i):
        if abs(z.get(i, 0)) <= wordmodel.SPARSITY:
            return 0.0
        pull = z[i] - math.copysign(wordmodel.SPARSITY, z[i])
        return -pull / ((wordmodel.SOFTENING + math.sqrt(n[i])) / wordmodel.RATE + wordmodel.RIDGE)

    for _ in range(wordmodel.PASSES):
        for r in order.permutation(3):
            at, values = rows[r]
            w = {i: weight(i) for i in at.tolist()}
            p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip(at.tolist(), values.tolist()))))
            for i, v in zip(at.tolist(), values.tolist()):
                g = (p - good[r]) * v
                before = n.get(i, 0.0)
                n[i] = before + g * g
                z[i] = z.get(i, 0.0) + g - (math.sqrt(n[i]) - math.sqrt(before)) / wordmodel.RATE * w[i]
    assert dict(zip(found.places.tolist(), found.weights.tolist())) == pytest.approx(
        {i: weight(i) for i in z if weight(i)}, rel=1e-4
    )


def test_features_of_a_text():
    words, forms = WordHashes(), wordmodel.FormHashes()
    at, values = wordmodel.text_features("A b a b", words, forms, 2**20)
    assert at[0] == 0 and len(set(at.tolist())) == len(at) and (values * values).sum() == pytest.approx(1)
    assert wordmodel.text_features(None, words, forms)[0].tolist() == [0]
    assert forms[b"THE!!"] == forms[b"OF!!"] != forms[b"the!!"]
    dots = wordmodel.sparse_dots([(at, values), (np.zeros(1, "<u4"), np.ones(1, "<f4"))], np.arange(2**20, dtype=float))
    assert dots.tolist() == pytest.approx([float((at * values.astype(float)).sum()), 0.0])
