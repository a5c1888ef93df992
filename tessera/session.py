"""Session construction, table loading and shared scratch/checkpoint folders."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Session used by tests and the bench (a cluster passes its own session in).

    AQE stays on: it coalesces small shuffle partitions, splits skewed join
    partitions and turns a sort-merge join into a broadcast join once the
    runtime size of a side is known to be small.
    """
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_settings(input_bytes: int, total_cores: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings sized to the input for a cluster run (pass to ``build_session(extra=...)``
    or ``spark-submit --conf``).

    Shuffle partitions start at about one per ``partition_bytes`` of input
    (at least 2x the cores) and AQE coalesces the small ones and splits
    skewed ones; scan splits stay at 256 MB so tasks fit executor memory.
    """
    parts = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Parquet keeps pushdown and column pruning."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition when a scan yields fewer tasks than cores.

    Large inputs already arrive in many splits and are left alone; only a
    few big row groups or unsplittable files (gzip) get spread before
    expensive per-row work. What comes out of a shuffle is left alone too:
    its partitions are sized at run time, and to ask for their number now
    would run the plan up to there.
    """
    if df._jdf.queryExecution().executedPlan().nodeName() == "AdaptiveSparkPlan":
        return df
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < want:
        return df.repartition(want)
    return df


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a machine-local folder would
    not survive the loss of an executor); only a local-mode session without
    it gets a private temporary folder, as in tests.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    cached = getattr(sc, "_tessera_root", None)
    if cached:
        return cached
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="tessera-")
    sc._tessera_root = root
    return root


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    sc.setCheckpointDir(os.path.join(shared_root(spark), "checkpoints"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return os.path.join(shared_root(spark), "scratch", f"{name}-{uuid.uuid4().hex}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's making, in whatever store it lies."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


class Scope:
    """Lifetime of what a job keeps for reuse: persisted inputs and staged tables go when the scope ends.

        with Scope(spark) as scope:
            features = scope.keep(daily.select(...))     # computed once, pruned before it is kept
            ...
            return scope.result(metrics)                 # a small result, taken out of the scope

    ``keep`` holds a DataFrame in executor memory and on their disks: lost
    parts are computed again. ``stage`` writes a table to the shared folder.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self._kept, self._paths = spark, [], []

    def __enter__(self) -> Scope:
        return self

    def __exit__(self, *_) -> None:
        for df in self._kept:
            df.unpersist()
        for path in self._paths:
            remove_path(self.spark, path)

    def keep(self, df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
        kept = df.persist(level)
        self._kept.append(kept)
        return kept

    def path(self, name: str) -> str:
        """A fresh folder of the shared scratch, removed at the end."""
        self._paths.append(scratch_path(self.spark, name))
        return self._paths[-1]

    def stage(self, df: DataFrame, name: str = "stage") -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def result(self, df: DataFrame, max_rows: int = 1000) -> DataFrame:
        """A result of a few rows that outlives the scope. More than ``max_rows`` are refused."""
        rows = df.limit(max_rows + 1).collect()
        if len(rows) > max_rows:
            raise ValueError(f"more than {max_rows} rows: write the result instead")
        return self.spark.createDataFrame(rows, df.schema)


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
