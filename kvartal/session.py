"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # run-time re-planning: joins by real size, merged small partitions, split hot ones
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # large expressions are built faster without a call site for every column
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # generated methods beyond 8,000 bytes of code are never compiled by the JVM, so steps that would make
    # a larger one run one by one
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # long descriptions: keep Arrow batches small in bytes, not only in rows
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def compiled_methods(spark: SparkSession) -> None:
    """The same limit of generated methods in a session that was made elsewhere."""
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, SETTINGS[name])


def build_session(app: str = "kvartal", master: str | None = None, **settings: str) -> SparkSession:
    """Session with the settings above; a cluster's own master and folders stay as given."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cpus: int = 8, app: str = "kvartal-local", **settings: str) -> SparkSession:
    """Single-machine session for tests and benches, without web page."""
    return build_session(
        app,
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": str(cpus),
            **settings,
        },
    )
