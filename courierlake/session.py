"""Session settings and the shared folder for cut lineage and derived files."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager, nullcontext

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Runtime settings the jobs are planned for. forceOptimizeSkewedJoin lets AQE split a hot join key even where the next
# operator reuses the join's partitioning; the extra shuffle it then needs
# appears only when there is a hot key.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Shuffle width: one partition per this much stored input. AQE merges small
# partitions but never adds any, so the width must fit the data from the start.
INPUT_PER_PARTITION = 512 * 1024**2
DEFAULT_WIDTH = 200

# Recording the Python line of every expression doubles the time it takes to
# put a model together.
START_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app_name: str = "courierlake", **conf: str) -> SparkSession:
    """A session with the settings above; `conf` entries win over them."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **START_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a session somebody else built.

    A key set on the application is left alone.
    """
    given = spark.sparkContext.getConf()
    for key, value in SETTINGS.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files below `path`, 0 if there are none; only their listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    try:
        return files.load(path).agg(F.sum("length")).first()[0] or 0
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def shuffle_width(spark: SparkSession, input_bytes: int) -> int:
    """Shuffle partitions for `input_bytes`; a width set on the application wins."""
    key = "spark.sql.shuffle.partitions"
    if spark.sparkContext.getConf().contains(key):
        return int(spark.conf.get(key))
    return max(DEFAULT_WIDTH, -(-input_bytes // INPUT_PER_PARTITION))


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, ready for checkpoints.

    Every executor must reach it. Only a local session, where all run in one
    process, may go without the setting and gets a fresh folder.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="courierlake-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def unless_given(spark: SparkSession, key: str, value: str) -> AbstractContextManager[None]:
    """A runtime setting for the actions inside the block; one of the application wins."""
    return nullcontext() if spark.sparkContext.getConf().contains(key) else setting(spark, key, value)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A runtime setting for the actions inside the block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
