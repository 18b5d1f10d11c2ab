"""Session settings that suit the engine; a cluster's own settings win.

The text operators lower two more in the session they run in (``llm.common.bound_batches``): the rows
and bytes of an Arrow batch, which stay lowered for its later queries.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int = 8, partitions: int = 8) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in {**DEFAULTS, "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
