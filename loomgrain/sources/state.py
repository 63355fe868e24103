"""Versioned state tables: appended parts, latest-wins views, atomic commits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgrain.operators.records import latest

SCHEMAS = {
    "sft_paper": "pmcid string, a string, e string, facets string",
    "paper_ctx": "pmcid string, context string",
    "gen": "pmcid string, pairs_json string, ok int, ts string",
    "pair": "id string, pmcid string, type string, question string, answer string, span string, kept int, reason string",
    "verdict": "id string, judged int",
}
KEYS = {"sft_paper": ["pmcid"], "paper_ctx": ["pmcid"], "gen": ["pmcid"], "pair": ["id"], "verdict": ["id"]}


class StateStore:
    """State tables under one folder. A commit is a new part that counts once its _SUCCESS mark is there.

    Beyond ``most_versions`` parts a table is written anew as one.
    """

    def __init__(self, spark: SparkSession, root: str, most_versions: int = 64):
        self.spark, self.root, self.most_versions = spark, root.rstrip("/"), most_versions

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self, table: str) -> list[int]:
        p, fs = self._fs(f"{self.root}/{table}")
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        done = [n for n in names if n.startswith("v=") and fs.exists(self._fs(f"{self.root}/{table}/{n}/_SUCCESS")[0])]
        return sorted(int(n[2:]) for n in done)

    def append(self, table: str, rows: DataFrame) -> None:
        """Commit rows as the next version; their keys take the place of earlier ones in ``read``."""
        known = self.versions(table)
        rows.write.mode("overwrite").parquet(f"{self.root}/{table}/v={max(known, default=-1) + 1}")
        if len(known) >= self.most_versions:
            self.replace(table, self.read(table))

    def replace(self, table: str, rows: DataFrame) -> None:
        """Truncate and reload: the new version is committed before earlier ones go."""
        old = self.versions(table)
        rows.write.mode("overwrite").parquet(f"{self.root}/{table}/v={max(old, default=-1) + 1}")
        for v in old:
            p, fs = self._fs(f"{self.root}/{table}/v={v}")
            fs.delete(p, True)

    def read(self, table: str) -> DataFrame:
        """The latest row of each key; an empty table if nothing was committed."""
        schema, versions = SCHEMAS[table], self.versions(table)
        if not versions:
            return self.spark.createDataFrame([], schema)
        if len(versions) == 1:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}/v={versions[0]}")
        paths = [f"{self.root}/{table}/v={v}" for v in versions]
        rows = self.spark.read.schema(f"{schema}, v int").option("basePath", f"{self.root}/{table}").parquet(*paths)
        return latest(rows, KEYS[table], "v").drop("v")

    def mark(self, stage: str) -> None:
        """Note that a stage is finished, as an empty file beside the tables."""
        p, fs = self._fs(f"{self.root}/_finished/{stage}")
        fs.create(p, True).close()

    def marks(self) -> set[str]:
        p, fs = self._fs(f"{self.root}/_finished")
        return {s.getPath().getName() for s in fs.listStatus(p)} if fs.exists(p) else set()

    def pairs(self) -> DataFrame:
        """Pairs with ``judged``: -1 unjudged, 0 rejected, 1 supported."""
        told = self.read("verdict")
        return self.read("pair").join(told, "id", "left").withColumn("judged", F.coalesce("judged", F.lit(-1)))
