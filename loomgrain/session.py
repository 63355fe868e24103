"""Session settings, shared scratch tables and shipping of this package to executors."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def build_session(app: str = "loomgrain", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session in UTC with adaptive execution; master and partitions only where the deployment sets none."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Let executors import this package even when it is not installed on them (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="loomgrain-ship-")) / "loomgrain_ship.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, Path("loomgrain") / p.relative_to(root))
    sc.addPyFile(str(target))


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else one of our own.

    Without the setting, a local master uses /tmp/checkpoints (one machine); a cluster uses the warehouse folder if its path
    names a store, and is asked for the setting if that would be a folder of each machine's own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local":
        return f"file:///tmp/checkpoints/loomgrain-{os.getuid()}"
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if "://" not in warehouse:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{warehouse}/_loomgrain_scratch"


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive the loss of executors.

    ``save`` writes a frame and returns it read back; ``drop`` deletes what no later step reads;
    ``release`` lets Spark delete shuffle files of plans that are no longer referenced.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
        self._n = 0
        self._saved: list[str] = []

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.base}/{self._n:03d}_{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        schema = df.schema
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(schema).parquet(path)
        out._loomgrain_path = path
        self._saved.append(path)
        return out

    def keep_only(self, *frames: DataFrame) -> None:
        """Delete all tables that were saved here but for those of frames, which are what a lazy result still reads."""
        kept = {getattr(f, "_loomgrain_path", None) for f in frames}
        for path in self._saved:
            if path not in kept:
                self.drop_path(path)
        self._saved = [p for p in self._saved if p in kept]

    def drop(self, df: DataFrame) -> None:
        path = getattr(df, "_loomgrain_path", None)
        if path:
            self.drop_path(path)

    def drop_path(self, path: str) -> None:
        jvm, jsc = self.spark._jvm, self.spark.sparkContext._jsc
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(jsc.hadoopConfiguration()).delete(p, True)

    def release(self) -> None:
        """Shuffle files go in the background once their plans are garbage: collect it twice, with time to delete between."""
        for wait in (0.0,) if self.spark.sparkContext.master.startswith("local[") else (1.0, 0.5):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(wait)


def spread(spark: SparkSession, total_bytes: int, target_bytes: int) -> int:
    """How many partitions hold total_bytes at target_bytes each; never fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(total_bytes) // target_bytes))
