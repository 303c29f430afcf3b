"""Session helpers: settings the operators rely on, and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

#: Most rows of a table that `spread` gives to a task.
ROWS_EACH = 250_000


def build_session(app: str = "postline", cpus: str = "*", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own.

    The method limit is the JVM's own: generated methods above it are never
    compiled, and wide projections then run many times slower.
    """
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="postline-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def spread(df: DataFrame) -> DataFrame:
    """The rows of a table dealt over all cores, four tasks to each or as many as a shuffle
    has, and more where a task would get over ROWS_EACH rows. They are counted by the files' footers.

    A file is read by no more tasks than it has row groups, and a group may hold a
    million narrow rows. Used before work that costs far more per row than a shuffle.
    """
    spark = df.sparkSession
    tasks = (4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // ROWS_EACH))
    return df.repartition(max(tasks))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df once as Parquet to the shared checkpoint folder and read it from there.

    Used where one result feeds several outputs: a lost executor costs a
    re-read and not a re-run, and the planner knows the size of what it reads.
    Never a local checkpoint. Columns without a type become text.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    typed = df.withColumns({f.name: F.col(f.name).cast("string") for f in df.schema if isinstance(f.dataType, NullType)})
    typed.write.parquet(path)
    return spark.read.schema(typed.schema).parquet(path)
