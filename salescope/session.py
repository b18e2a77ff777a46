"""Session helpers.

Library code never builds its own session: every operator takes a DataFrame
(or a SparkSession handed in by the caller).  ``local_session`` is only for
tests, the bench and examples.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "salescope") -> SparkSession:
    """A local session configured the way the library expects a cluster to be.

    AQE stays on so that small aggregated sides are broadcast only after
    their runtime size is known, skewed shuffle partitions are split and
    tiny ones coalesced.
    """
    parts = shuffle_partitions or (os.cpu_count() if cores == "*" else int(cores))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SALESCOPE_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as given.  Only a local-mode session (tests) without the setting gets a
    scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    path = tempfile.mkdtemp(prefix="salescope-ckpt-")
    sc.setCheckpointDir(path)
    return path


#: Folder column of tables that are kept by month: the month's first day.
MONTH = "month_start"


def materialize(df: DataFrame, name: str, by_month_of: str | None = None,
                rows_a_file: int | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back: a reliable cut of the lineage whose later reads are column-pruned
    parquet scans (executors write, nothing passes through the driver).
    ``by_month_of``: a date column by whose months the folders are laid out;
    the table gets the column ``MONTH``, which ``since`` filters on.
    ``rows_a_file``: files of at most so many rows, for tables whose readers do
    much with each row: a file of few bytes is otherwise one task's."""
    import uuid
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    if by_month_of:
        df = df.withColumn(MONTH, F.trunc(by_month_of, "month")).repartition(MONTH)
        df.write.partitionBy(MONTH).mode("overwrite").parquet(path)
    else:
        df.write.mode("overwrite").option("maxRecordsPerFile", rows_a_file or 0).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def since(df: DataFrame, date_col: str, first) -> DataFrame:
    """Rows from the day ``first`` on; of a table kept by month only the
    folders from its month on are read."""
    out = df.where(F.col(date_col) >= F.lit(first))
    return out.where(F.col(MONTH) >= F.lit(first.replace(day=1))) if MONTH in df.columns else out
