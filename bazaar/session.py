"""Session settings and the shared work folder."""

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Where every partition of one side is found small at run time, hash it instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Constraint inference grows exponentially on staged CASE columns used by several joins: minutes of
    # planning for the fact. The null filters it would add to join keys are written out where they matter.
    "spark.sql.constraintPropagation.enabled": "false",
}


# Plans of the lake write a table and go on from it, so nothing reads an execution's shuffle files once it has ended. Left to
# the driver's garbage collection they pile up: a driver that collects little keeps those of every table since.
FREED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
# Tables that are kept lie in this codec; documents and keys take a half to two thirds of the room they take in the default one.
CODEC = "zstd"


def settle(spark: SparkSession, lake: bool = False) -> SparkSession:
    """Apply the settings every plan here relies on: UTC timestamps, adaptive plans, skew splitting.

    Plans of the `lake` also free the shuffle files of an execution at its end.
    """
    freed = FREED if lake else dict.fromkeys(FREED, "false")
    for name, value in (SETTINGS | freed).items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", name: str = "bazaar", **conf: str) -> SparkSession:
    """Session for tests and benches on one machine; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return settle(spark)


# Folders, by (application, folder), in which the driver found every row that tasks wrote.
_SHARED: set[tuple[str, str]] = set()


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, or else the warehouse.

    Both are named by whoever runs the session; nothing falls back to a temporary folder. A path without a scheme, or of
    file:, may lie on a machine's own disk or on one that all machines mount: on a cluster, rows that its tasks write there
    must come back, or tables would lack rows without a word.
    """
    root = (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")
    plain = root.startswith(("/", "file:")) and not _default_is_shared(spark, root)
    if plain and not spark.sparkContext.master.startswith("local"):
        key = (spark.sparkContext.applicationId, root)
        if key not in _SHARED:
            if not _come_back(spark, root):
                raise ValueError("spark.checkpoint.dir or spark.sql.warehouse.dir must name a folder shared by all executors")
            _SHARED.add(key)
    return root


def _come_back(spark: SparkSession, root: str) -> bool:
    """Whether rows that all cores write below the folder are read back."""
    path = f"{root}/bazaar/{spark.sparkContext.applicationId}/shared-{uuid.uuid4().hex}"
    tasks = 2 * spark.sparkContext.defaultParallelism
    try:
        spark.range(0, tasks, 1, tasks).write.parquet(path)
        return spark.read.option("ignoreMissingFiles", "true").schema("id long").parquet(path).count() == tasks
    finally:
        remove(spark, path)


def _default_is_shared(spark: SparkSession, root: str) -> bool:
    """Whether a path without a scheme lies in a shared file system."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    return root.startswith("/") and not default.startswith("file:")


def _home(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/bazaar/{spark.sparkContext.applicationId}"


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new, empty folder name under the shared root, in the folder of this application."""
    return f"{_home(spark)}/{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it lies; one that is not there is fine."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder within its file system."""
    where, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).rename(where, target)


def clean(spark: SparkSession) -> None:
    """Delete every work folder of this application. Results that still read them end here."""
    remove(spark, _home(spark))
