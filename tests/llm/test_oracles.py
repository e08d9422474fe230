"""Queries with SQL against it, row by row."""

from collections import Counter

import duckdb
import pytest

from kvartal import fixtures
from kvartal.llm.oracles import ORACLES
from kvartal.llm.queries import QUERIES
from tests.llm.plain import odd_documents

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(found, connection, sql):
    answer = connection.execute(sql)
    names = [c[0] for c in answer.description]
    assert sorted(names) == sorted(found.columns)
    assert {f.name: KINDS[f.dataType.simpleString()] for f in found.schema} == {
        c[0]: str(c[1]) for c in answer.description
    }
    order = [found.columns.index(name) for name in names]
    mine = Counter(tuple(row[i] for i in order) for row in found.collect())
    assert mine == Counter(answer.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in fixtures.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    compare(QUERIES[name](spark, sf_dir), connection, ORACLES[name])


@pytest.mark.parametrize("name", [n for n in sorted(ORACLES) if n not in ("op5_chat_tree", "op11_centroid_clusters")])
@pytest.mark.parametrize("empty", [False, True])
def test_odd_documents(spark, folder, name, empty):
    odd_documents(spark).limit(0 if empty else 100).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(
        [(0, "Words words, \u00e9cole 7x\x00the river"), (1, None), (None, "")], "item_id long, text string"
    ).limit(0 if empty else 9).coalesce(1).write.parquet(f"{folder}/benchmark.parquet")
    connection = duckdb.connect()
    for table in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    compare(QUERIES[name](spark, folder), connection, ORACLES[name])


@pytest.mark.parametrize("empty", [False, True])
def test_odd_conversations(spark, folder, empty):
    rows = [
        (1, 0, "user", "a"), (1, 1, "assistant", "b\\"), (2, 0, "user", "a"), (2, 1, "assistant", "[INST] \\\\<s>"),
        (3, 0, "user", "a"), (4, 0, None, None), (5, None, "ro\\n\nle", "<|im_end|>\n"), (5, 2, "assistant", ""),
        (None, 0, "user", "a"), (None, 1, "assistant", "é😀" * 9000), (6, 3, "assistant", "z"), (6, 3, "assistant", "z"),
        (7, 0, "user", "a"), (7, 1, "assistant", "b\\"), (7, 2, "user", "more"),
    ]
    spark.createDataFrame(
        [(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, node string, idx int"
    ).limit(0 if empty else 100).coalesce(2).write.parquet(f"{folder}/conversations.parquet")
    connection = duckdb.connect()
    connection.execute(
        f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'"
    )
    compare(QUERIES["op5_chat_tree"](spark, folder), connection, ORACLES["op5_chat_tree"])


@pytest.mark.parametrize("rows", [0, 3, 100])
def test_odd_vectors(spark, folder, rows):
    """Fewer vectors than clusters, ties, copies, null ids, and vectors that are left out."""
    flat = lambda *head: [float(x) for x in head] + [0.0] * (64 - len(head))
    odd = [
        (1, flat(1, 2)), (2, flat(-1, 2.5)), (2**53 + 1, flat(0.0004, -0.0004)), (None, flat(5, 5)), (2**53, flat(5, 5)),
        (4, None), (5, []), (6, flat(1)[:63]), (7, flat(float("nan"))), (8, flat(float("-inf"))), (9, [None, *flat()[1:]]),
        *((10 + i // 2, flat(i % 3, i // 7)) for i in range(40)), (1, flat(1, 2)),
    ]
    spark.createDataFrame(
        [(i, v, 1, 2, 3) for i, v in odd], "vec_id long, embedding array<float>, id int, block int, vector int"
    ).limit(rows).coalesce(2).write.parquet(f"{folder}/embeddings.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet/*.parquet'")
    compare(QUERIES["op11_centroid_clusters"](spark, folder), connection, ORACLES["op11_centroid_clusters"])
