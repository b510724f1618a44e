"""Session settings the models depend on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Dates and months are defined in UTC. Skew splitting is forced because a hot
# tournament may sit under an aggregate that reuses the join's partitioning; without
# the flag Spark keeps such a partition whole to save the extra exchange.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# The shuffled bytes a task is given where adaptive execution merges partitions. A task of the monthly
# revenue sorts and counts its rows several times over and holds some 40 times these compressed bytes
# (1.6 GB for 40 MB; Spark's own size is 64 MB). It holds while there are partitions enough to merge.
#
# The same for the bytes of a file that a task scans, where the latest row of each registration is taken before
# the first shuffle: a task sorts all rows it scanned (1.6 GB, and spills, for the 70 MB of a fourth of a file;
# Spark's own size is 128 MB). A row group is never split.
SIZES = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "8m",
}

# The partitions a shuffle starts with where the session names fewer, or a task's rows would be the table's
# divided by those few. As many as a map task writes without holding its rows
# (spark.shuffle.sort.bypassMergeThreshold); adaptive execution merges what is too small.
PARTITIONS = "spark.sql.shuffle.partitions"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
FEWEST = 200

CHECKPOINT_DIR = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Set REQUIRED on the caller's session, which every model needs, SIZES where the cluster names none, and
    FEWEST partitions to start with where it names fewer; memory stays with the cluster."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    for key, value in SIZES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    few = int(spark.conf.get(PARTITIONS)) < FEWEST
    initial = spark.conf.get(INITIAL_PARTITIONS, None)
    if few and initial is None:
        spark.conf.set(INITIAL_PARTITIONS, str(FEWEST))
    elif not few and initial == str(FEWEST):
        spark.conf.unset(INITIAL_PARTITIONS)  # set here while the session named fewer
    return spark


def local_session(cores: int = 8, app: str = "stellate", **conf: str) -> SparkSession:
    """A session for tests and the local bench, with the web page off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config(PARTITIONS, str(cores))
        .config(INITIAL_PARTITIONS, str(cores))
    )
    for key, value in {**REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder of this application under the shared folder the cluster names.

    No two calls share a folder, so a later write never breaks an earlier result. Only on a
    local master, where all tasks share one machine, is a folder of our own used in its place.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"name a folder that all executors share in {CHECKPOINT_DIR}")
        root = tempfile.mkdtemp(prefix="stellate-")
        spark.conf.set(CHECKPOINT_DIR, root)
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}/{name}"
