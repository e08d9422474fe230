"""The daily run: layers, gates, publishing, landing and files."""

import os
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kvartal import schemas
from kvartal.catalogue.queries import QUERIES
from kvartal.operators import checks
from kvartal.plans.run import run_layers
from kvartal.sources import landing, listings_csv, publishing
from kvartal.sources.staging import shared_folder, stage
from rows import bronze

TODAY = date(2026, 5, 3)


def good(spark, count=8):
    return bronze(spark, *(
        {"listing_id": str(i), "total_area_m2": 50.0 + i, "url": f"u-ID{i}.html"}
        for i in range(count)
    ))


def test_run_publishes_all_layers(spark, folder):
    result = run_layers(good(spark), folder, TODAY)
    assert result.rows == {"bronze": 8, "silver": 8}
    assert result.checks.filter("NOT passed").count() == 0
    stored = publishing.current_table(spark, folder, "silver", "listings")
    assert stored.columns == [*schemas.SILVER.names, schemas.LOAD_TIME]
    publishing.serve(spark, folder, "gold", schemas.GOLD)
    assert spark.sql("""
        SELECT count(*) FROM fact_listing JOIN dim_location USING (location_dim_id)
        JOIN dim_property USING (property_dim_id) JOIN dim_listing_attributes USING (listing_id)
    """).first()[0] == 8


def test_a_run_leaves_no_staged_tables(spark, folder):
    def staged():
        place = os.path.join(shared_folder(spark), "staged")
        return set(os.listdir(place)) if os.path.isdir(place) else set()

    before = staged()
    run_layers(good(spark), folder, TODAY)
    assert staged() == before
    stage(good(spark), "kept")
    assert len(staged() - before) == 1


def test_second_run_replaces_the_first(spark, folder):
    first = run_layers(good(spark, 4), folder, TODAY)
    second = run_layers(good(spark, 6), folder, TODAY)
    assert first.run != second.run
    assert publishing.current_run(spark, folder, "gold") == second.run
    assert publishing.current_table(spark, folder, "gold", "fact_listing").count() == 6


def test_failed_check_stops_before_publishing(spark, folder):
    run_layers(good(spark, 4), folder, TODAY)
    old = publishing.current_run(spark, folder, "silver")
    bad = good(spark).withColumn("build_year", F.lit(1800.0))
    with pytest.raises(checks.ChecksFailed, match="build_year"):
        run_layers(bad, folder, TODAY)
    assert publishing.current_run(spark, folder, "silver") == old
    assert publishing.current_run(spark, folder, "bronze") != old
    with pytest.raises(checks.ChecksFailed, match="build_year"):
        run_layers(bad, folder, TODAY, gated=False)
    assert publishing.current_table(spark, folder, "gold", "fact_listing").count() == 8


def test_nothing_published(spark, folder):
    run_layers(good(spark, 4), folder, TODAY)
    with pytest.raises(LookupError):
        publishing.current_run(spark, folder, "platinum")


def test_csv_keeps_quotes_commas_breaks_and_mark(spark, folder):
    text = 'He said "yes, please"\n\nand left;  "" \\ end\\'
    rows = bronze(spark, {"description": text, "district": " two  blanks ", "rooms": None})
    listings_csv.write_listings(rows, f"{folder}/csv", files=1)
    assert listings_csv.read_listings(spark, f"{folder}/csv").collect() == rows.collect()
    header = ",".join(schemas.BRONZE.names)
    values = ",".join("" for _ in schemas.BRONZE.names[1:])
    with open(f"{folder}/marked.csv", "w", encoding="utf-8-sig") as f:
        f.write(f"{header}\nid1{values and ','}{values}\n")
    assert listings_csv.read_listings(spark, f"{folder}/marked.csv").first().listing_id == "id1"


def test_csv_with_a_bad_number_or_header_fails(spark, folder):
    names = schemas.BRONZE.names
    line = ",".join("x" if c == "rooms" else "" for c in names)
    for name, header in (("number", names), ("header", names[::-1])):
        with open(f"{folder}/{name}.csv", "w", encoding="utf-8") as f:
            f.write(",".join(header) + "\n" + line + "\n")
        with pytest.raises(Exception):
            listings_csv.read_listings(spark, f"{folder}/{name}.csv").collect()
    loose = listings_csv.read_listings(spark, f"{folder}/number.csv", bad_rows="PERMISSIVE")
    assert loose.first().rooms is None


def test_sample_is_one_file_with_the_first_rows(spark, folder):
    listings_csv.write_sample(good(spark, 30), f"{folder}/sample", rows=3)
    back = listings_csv.read_listings(spark, f"{folder}/sample")
    assert [r.listing_id for r in back.collect()] == ["0", "1", "10"]
    assert len(back.inputFiles()) == 1


def test_unseen_by_id_or_url_and_once_per_run(spark):
    old = bronze(
        spark, {"listing_id": "777", "url": "x-IDold.html"},
        {"listing_id": "slug", "url": "plain"}, {"listing_id": None, "url": None},
    )
    urls = ["a-IDold.html", "b-IDslug.html", "b-ID777.html", "plain", "n-IDnew.html",
            "m-IDnew.html", "other"]
    found = spark.createDataFrame([(u, i) for i, u in enumerate(urls)], "url string, position int")
    new = landing.unseen(found, old, order="position")
    assert sorted(r.url for r in new.collect()) == ["n-IDnew.html", "other"]
    assert [r.url for r in landing.unseen(found, old, "position", at_most=1).collect()] == [
        "n-IDnew.html"
    ]


def test_append_adds_and_keeps(spark, folder):
    with pytest.raises(LookupError):
        landing.landed(spark, folder)
    landing.append(good(spark, 3), folder, "a")
    candidates = good(spark, 5)
    fresh = landing.unseen(candidates, landing.landed(spark, folder))
    for _ in range(2):  # a batch sent again is not added again
        landing.append(fresh, folder, "b")
    stored = landing.landed(spark, folder)
    assert sorted(r.listing_id for r in stored.collect()) == ["0", "1", "2", "3", "4"]
    assert landing.extended(stored, candidates).count() == 10


def test_a_broken_append_is_not_seen(spark, folder):
    landing.append(good(spark, 3), folder, "a")
    # written, but the log line is missing
    good(spark, 8).write.parquet(publishing.table_path(folder, landing.LAYER, "b", landing.TABLE))
    assert landing.landed(spark, folder).count() == 3
    landing.append(good(spark, 4), folder, "b")
    assert landing.landed(spark, folder).count() == 7


def test_csv_keeps_empty_texts_apart_from_missing_ones(spark, folder):
    rows = bronze(
        spark, {"listing_id": "1", "url": "", "district": None}, {"listing_id": "", "district": ""},
        {"listing_id": "\\N", "url": "NULL", "district": "null"},
    )
    listings_csv.write_listings(rows, f"{folder}/csv", file_rows=1)
    back = listings_csv.read_listings(spark, f"{folder}/csv")
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
    assert len(back.inputFiles()) >= 3


def test_compressed_csv_comes_back_unchanged(spark, folder):
    texts = ['a "quoted", text\nwith lines', "", None, "\r\n,", "x" * 5000]
    rows = bronze(spark, *({"listing_id": str(i), "description": t, "nearby": t} for i, t in enumerate(texts * 40)))
    sizes = {}
    for compression in ("none", "gzip", "lz4"):
        path = f"{folder}/{compression}"
        listings_csv.write_listings(rows, path, files=1, file_rows=50, compression=compression)
        files = [p for p in os.listdir(path) if p.startswith("part-")]
        sizes[compression] = sum(os.path.getsize(f"{path}/{p}") for p in files)
        assert len(files) == 4
        back = listings_csv.read_listings(spark, path, rows.schema)
        assert back.exceptAll(rows).isEmpty() and back.count() == rows.count()
    assert max(sizes["gzip"], sizes["lz4"]) < sizes["none"] / 5


def test_csv_roundtrip_writes_compressed_files(spark, sf_dir):
    back = QUERIES["csv_roundtrip"](spark, sf_dir)
    assert back.inputFiles() and all(path.endswith(".csv.lz4") for path in back.inputFiles())


def test_tables_are_compressed(spark, folder):
    """Staged and published tables are smaller than by the default codec."""
    rows = spark.range(50).selectExpr("id", "repeat(concat('text ', id), 20) AS text")
    path = publishing.table_path(folder, "silver", "r", "rows")
    publishing.write_table(rows, folder, "silver", "r", "rows")
    staged = stage(rows, "rows").inputFiles()
    files = [f.removeprefix("file://") for f in (*staged, *spark.read.parquet(path).inputFiles())]
    assert {pq.ParquetFile(f).metadata.row_group(0).column(1).compression for f in files} == {"ZSTD"}
