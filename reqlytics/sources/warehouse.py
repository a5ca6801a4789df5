"""Layers on shared storage: which folder a layer lives in, and full-rebuild table writes."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from reqlytics.session import SETTINGS

# Default layer -> folder names. A custom name is used exactly as given.
LAYERS = {"bronze": "bronze", "silver": "silver", "gold": "gold", "seeds": "silver", "manifests": "manifests"}


def scratch_root(spark: SparkSession) -> str:
    """A new folder under the shared directory the cluster names in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        import tempfile

        base = tempfile.mkdtemp(prefix="reqlytics-")  # single-machine session only, as in tests
    return f"{base.rstrip('/')}/reqlytics-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of any store that Spark reaches; one that is not there is left alone."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def discard_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application: at the end of a job, when nothing reads them."""
    root = _scratch.pop(spark.sparkContext.applicationId, "")
    if root:
        remove(spark, root)


_scratch: dict[str, str] = {}


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result once and read it back: cuts lineage, survives lost executors."""
    return materialise_counted(df, name)[0]


def materialise_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """As :func:`materialise`, with the number of rows, observed while they are written."""
    spark = df.sparkSession
    root = _scratch.setdefault(spark.sparkContext.applicationId, "") or scratch_root(spark)
    _scratch[spark.sparkContext.applicationId] = root
    path = f"{root}/scratch/{name}-{uuid.uuid4().hex[:12]}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get["n"]


class RowCounts:
    """Rows per key, counted by the tasks that write them; nothing is read back.

    Keys are whole numbers below ``n``. A histogram with room for every key is kept by each task and merged when the task has
    succeeded, so a task that is tried again counts once. Bins of one key lie closer than any two keys, so only they are
    merged; their places are averages and off by rounding alone. One holds ``KEYS`` keys, more keys take more.
    """

    KEYS = 1024

    def __init__(self, n: int) -> None:
        self.parts = -(-n // self.KEYS)
        self.seen = Observation()

    def watch(self, df: DataFrame, key: str) -> DataFrame:
        parts = [
            F.histogram_numeric(F.when(F.floor(F.col(key) / self.KEYS) == k, F.col(key).cast("double")), F.lit(self.KEYS)).alias(f"part{k}")
            for k in range(self.parts)
        ]
        return df.observe(self.seen, F.count(F.lit(1)).alias("all"), *parts)

    def get(self) -> tuple[int, dict[int, int]]:
        """All rows, and those of each key that has any; only after the write."""
        found: dict[int, int] = {}
        told = self.seen.get
        for k in range(self.parts):
            for key, n in told[f"part{k}"] or []:
                found[round(key)] = found.get(round(key), 0) + round(n)
        return told["all"], found


#: Partitions a task writes side by side. Without it a task holds and sorts all its rows, wide as they are, before it writes them.
OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@dataclass
class Warehouse:
    """Parquet tables below one root. Writing a table replaces it (full rebuild).

    A session that does not say how many partitions a task writes side by side gets the library's own number.
    """

    spark: SparkSession
    root: str
    layers: Mapping[str, str] = field(default_factory=lambda: dict(LAYERS))

    def __post_init__(self) -> None:
        if self.spark.conf.get(OPEN_WRITERS, None) is None:
            self.spark.conf.set(OPEN_WRITERS, SETTINGS[OPEN_WRITERS])

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{self.layers.get(layer, layer).strip()}/{table}"

    def write(
        self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(layer, table))
        # the schema is known: no file is opened to infer it, and '2026Q1'-like values stay text
        fields = [f for f in df.schema if f.name not in partition_by]
        fields += [df.schema[name] for name in partition_by]
        return self.read(layer, table, type(df.schema)(fields)).select(*df.columns)

    def replace_partitions(
        self, df: DataFrame, layer: str, table: str, partition: str, values: Sequence[str]
    ) -> DataFrame:
        """Replace the partitions ``values`` by ``df``, which holds no others; returns those partitions.

        A partition without rows from now on is deleted; all others are not touched.
        """
        path, seen = self.path(layer, table), Observation()
        watched = df.observe(seen, F.collect_set(F.col(partition).cast("string")).alias("present"))
        watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
        for value in sorted(set(values) - set(seen.get["present"])):
            remove(self.spark, f"{path}/{partition}={value}")
        fields = [f for f in df.schema if f.name != partition] + [df.schema[partition]]
        stored = self.read(layer, table, type(df.schema)(fields)).select(*df.columns)
        return stored.where(F.col(partition).isin(list(values)))

    def read(self, layer: str, table: str, schema=None) -> DataFrame:
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(self.path(layer, table))


def run_query(spark: SparkSession, sql: str, quarters: Sequence[str] = (), **tables: DataFrame) -> DataFrame:
    """Parameterised SQL over named frames: ``{rpt}`` is a table, ``:quarters`` the period list."""
    listed = F.array(*[F.lit(q) for q in quarters])
    return spark.sql(sql, args={"quarters": listed}, **tables)
