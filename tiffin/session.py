"""Session builder and the shared scratch folder.

Library code never changes session settings. Anything it must write goes under the folder named by
``spark.checkpoint.dir``, which every executor can reach, so that a lost executor loses no data.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tiffin.lineage import copied

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "tiffin", cores: int | str = "*", shuffle_partitions: int = 8,
                  memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The shared folder. A private temporary folder is used in local mode only."""
    root = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    root = tempfile.mkdtemp(prefix="tiffin-")
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A new, never reused folder for one run."""
    return f"{shared_root(spark)}/tiffin/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where two branches must see the very same rows and row order. A written table survives
    executor loss, cuts the lineage and, unlike a row checkpoint, still allows column pruning.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    copied(path, df)
    return spark.read.schema(df.schema).parquet(path)


def tasks(df: DataFrame, rows: int = 500_000) -> int:
    """Tasks that get about ``rows`` rows each, and no fewer than a shuffle has. Of a table in files
    the count comes from footers."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-df.count() // rows))
