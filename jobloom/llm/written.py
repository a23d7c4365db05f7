"""Tables written between the steps of an operator."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Spark's setting; without it shuffle files stay until the driver collects garbage.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write df down and read it again. The shuffle files of the write go as soon as it is done, so that
    steps do not add up on the disk. The session keeps its settings."""
    conf = df.sparkSession.conf
    before = conf.get(RELEASE, None)
    conf.set(RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(RELEASE)
        else:
            conf.set(RELEASE, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)
