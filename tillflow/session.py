"""Session set-up and the shared folder for tables written on the way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
PARTITION_BYTES = 1024**3
LEAST_PARTITIONS = 200


def build_session(
    app: str = "tillflow", master: str | None = None, shuffled_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` keys use ``__`` for dots.

    ``shuffled_bytes`` is what the largest shuffle will move, and sets its partitions: the
    facts themselves for a join that moves them, a few groups a task for a roll-up.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffled_bytes:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions(shuffled_bytes))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shuffle_partitions(shuffled_bytes: int) -> int:
    """A partition for every gigabyte that is shuffled. Every task writes an index of all
    of them, so small partitions cost more than they help; adaptive execution merges those
    that turn out small and splits those of hot keys in joins."""
    return max(LEAST_PARTITIONS, -(-shuffled_bytes // PARTITION_BYTES))


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it gets a folder of its
    own, once. On a cluster a machine-local folder would not be seen by the
    other machines, so a missing setting is an error there.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tillflow-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody has used yet."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def emptied(spark: SparkSession, path: str) -> None:
    """Frees the space of a table nobody will read again: an empty one replaces it."""
    spark.range(0).write.mode("overwrite").parquet(path)


def stored(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where a small table derived from all the facts feeds several jobs: the
    facts are read once, a lost executor does not bring the scan back, and the
    planner knows the size of what it reads. Rows with other values of the columns ``by``
    lie in folders of their own, so that a job that wants some of them reads no others.
    """
    path = new_folder(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
