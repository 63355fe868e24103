"""Sources: JSON line shards in document order, chat lines, whole files, replay resolution, cached tables."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from loomgrain.operators.records import MESSAGES, chat_pairs, dense_positions


def file_system(spark: SparkSession, where: str):
    """(path, its file system) of any store that Spark reads."""
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def shard_states(spark: SparkSession, folder: str) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change in ms) of *.jsonl.gz in order of path, then of *.jsonl."""
    path, fs = file_system(spark, folder)
    states = sorted((s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(path)) if fs.exists(path) else []
    found = [s for kind in (".jsonl.gz", ".jsonl") for s in states if s[0].endswith(kind)]
    if not found:
        raise FileNotFoundError(f"no .jsonl or .jsonl.gz files in {folder}")
    return found


def list_shards(spark: SparkSession, folder: str) -> list[str]:
    """Paths of *.jsonl.gz sorted, then *.jsonl sorted."""
    return [s[0] for s in shard_states(spark, folder)]


def read_shards(spark: SparkSession, folder: str, field: str = "text", max_docs: int | None = None) -> DataFrame:
    """(file_rank, line_id, text): one row a line, in an order fixed by file and place in it; other fields are not parsed."""
    files = list_shards(spark, folder)
    ranks = spark.createDataFrame([(f, i) for i, f in enumerate(files)], "path string, file_rank int")
    lines = spark.read.schema(f"`{field}` string").json(files)
    lines = lines.select(F.col(field).alias("text"), F.col("_metadata.file_path").alias("path"), F.monotonically_increasing_id().alias("line_id"))
    named = lines.withColumn("name", F.substring_index("path", "/", -1))
    out = named.join(F.broadcast(ranks.select("file_rank", F.substring_index("path", "/", -1).alias("name"))), "name")
    out = out.select("file_rank", "line_id", "text")
    return out if max_docs is None else out.orderBy("file_rank", "line_id").limit(max_docs)


def read_chat_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_id, messages): one row for each line that is not blank; messages is null where the line is no chat record."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_id"), F.trim("value").alias("value"))
    parsed = F.from_json("value", f"messages {MESSAGES}", {"mode": "PERMISSIVE"})
    return lines.where("value <> ''").select("line_id", parsed["messages"].alias("messages"))


@pandas_udf(StringType())
def _lenient(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda b: None if b is None else bytes(b).decode("utf-8", "ignore"))


_GLOB = re.compile(r"([\[\]{}*?\\])")


def read_whole_files(spark: SparkSession, store: str, wanted: list[tuple[str, str]], key: str = "pmcid") -> DataFrame:
    """key and text of the files wanted, as (key, path under the store); nothing else in the store is read.

    The caller hands over a chunk at a time. Undecodable bytes are left out; a file that is missing or can't be read gives null.
    """
    rows, there = [], []
    for k, name in wanted:
        path, fs = file_system(spark, f"{store.rstrip('/')}/{name}")
        if name and fs.exists(path):
            where = fs.makeQualified(path)
            rows.append((k, where.toUri().getPath()))
            there.append(_GLOB.sub(r"\\\1", where.toString()))
        else:
            rows.append((k, None))
    asked = spark.createDataFrame(rows, f"{key} string, __path string")
    if not there:
        return asked.select(key, F.lit(None).cast("string").alias("text"))
    files = spark.read.format("binaryFile").option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true").load(sorted(set(there)))
    plain = F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?", "")
    texts = files.select(plain.alias("__path"), _lenient("content").alias("text"))
    return asked.join(texts, "__path", "left").select(key, "text")


def resolve_replay(spark: SparkSession, where: str, field: str = "text", tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """A replay source: a folder of shards if the path exists, else a named table; there is no network source."""
    path, fs = file_system(spark, where)
    if fs.exists(path):
        return read_shards(spark, where, field).select("text")
    if tables and where in tables:
        return tables[where].select(F.col(field).alias("text"))
    if spark.catalog.tableExists(where):
        return spark.table(where).select(F.col(field).alias("text"))
    raise FileNotFoundError(f"{where} is neither a folder nor a known table")


def read_chat_replay(spark: SparkSession, path: str) -> DataFrame:
    """(pos, payload) of a file of chat records to mix in: the messages as JSON, records without both turns left out."""
    lines = chat_pairs(read_chat_lines(spark, path)).where(~F.col("malformed"))
    dense = dense_positions(lines.select("line_id", "messages"), ["line_id"], "pos")
    return dense.select("pos", F.to_json("messages").alias("payload"))


def read_existing(spark: SparkSession, path: str, what: str, kind: str = "parquet") -> DataFrame:
    """A table that an earlier stage wrote; says what is missing if it did not."""
    p, fs = file_system(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(f"{what} not found at {path}; run the stage that writes it first")
    return spark.read.format(kind).load(path)
