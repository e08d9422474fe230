"""The daily run: bronze, silver and gold with checks between the layers."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, functions as F

from kvartal import schemas
from kvartal.operators import checks
from kvartal.plans.gold import write_gold
from kvartal.plans.silver import clean
from kvartal.sources import publishing
from kvartal.sources.staging import staged_tables


@dataclass(frozen=True)
class RunResult:
    run: str
    rows: dict[str, int]
    checks: DataFrame


def run_layers(
    bronze: DataFrame,
    root: str,
    as_of: date,
    per_usd: Mapping[str, float] | None = None,
    gated: bool = True,
) -> RunResult:
    """Write and publish all layers from a frame of raw listings.

    Each layer is written under a folder of this run, checked, and then published.
    A failed check stops the run before the layer is published; the layers before
    stay published. With ``gated=False`` all layers are written and published, and
    the first failure is raised at the end.
    """
    with staged_tables(bronze.sparkSession):
        return _run_layers(bronze, root, as_of, per_usd, gated)


def _run_layers(
    bronze: DataFrame,
    root: str,
    as_of: date,
    per_usd: Mapping[str, float] | None,
    gated: bool,
) -> RunResult:
    spark = bronze.sparkSession
    run = publishing.new_run()
    rows: dict[str, int] = {}
    reports: list[DataFrame] = []
    failures: list[checks.ChecksFailed] = []

    def counted(df: DataFrame, layer: str) -> tuple[DataFrame, Observation]:
        seen = Observation(f"{layer}-{run}")
        return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen

    def finish(layer: str, report: DataFrame) -> None:
        written = publishing.write_table(report, root, "checks", run, layer)
        reports.append(written)
        try:
            checks.require(written)
        except checks.ChecksFailed as failed:
            if gated:
                raise
            failures.append(failed)
        publishing.publish(spark, root, layer, run)

    raw, seen = counted(bronze, "bronze")
    raw = publishing.write_table(raw, root, "bronze", run, "listings")
    rows["bronze"] = seen.get["rows"]
    finish("bronze", checks.bronze_checks(raw))

    cleaned, seen = counted(clean(raw, as_of, per_usd), "silver")
    stamped = cleaned.withColumn(schemas.LOAD_TIME, F.current_timestamp())
    silver = publishing.write_table(stamped, root, "silver", run, "listings")
    rows["silver"] = seen.get["rows"]
    finish("silver", checks.silver_checks(silver, as_of))

    gold = write_gold(silver, root, run)
    report = checks.gold_checks(
        silver, gold["fact_listing"], gold["dim_property"], gold["dim_location"],
        gold["dim_listing_attributes"],
    )
    finish("gold", report)
    publishing.publish(spark, root, "checks", run)
    if failures:
        raise failures[0]
    all_checks = reports[0].unionByName(reports[1]).unionByName(reports[2])
    return RunResult(run, rows, all_checks)
