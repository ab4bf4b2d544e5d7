"""Session settings the library relies on; everything else stays with the cluster."""

from pyspark.sql import SparkSession

# UTC for the naive times of files, runtime re-planning, and a state store that spills to disk.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings to a session builder."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
