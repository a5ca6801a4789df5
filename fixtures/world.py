"""The derived releases as a running warehouse: built once per session and scale, then shared."""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fixtures import derived
from reqlytics.contract import Layout
from reqlytics.plans.load import load_release, read_bronze
from reqlytics.plans.medallion import Medallion
from reqlytics.sources import seeds
from reqlytics.sources.releases import Release, read_release
from reqlytics.sources.warehouse import Warehouse, scratch_root

RELEASE_ROWS = 1_000_000
PLAIN_CSV = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "escape": '"'}


class World:
    """Lookups as CSV seeds, layers as Parquet, releases as text files: all below one scratch root."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self.warehouse = Warehouse(spark, scratch_root(spark))
        self.contract = derived.CONTRACT

    def _seed(self, frame: DataFrame, name: str) -> str:
        path = self.warehouse.path("seeds", f"seed_{name}")
        frame.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
        return path

    @cached_property
    def issue_map(self) -> DataFrame:
        path = self._seed(derived.issue_map(self.spark, self.sf_dir), "issue_map")
        return seeds.read_issue_map(self.spark, path)

    @cached_property
    def location_map(self) -> DataFrame:
        path = self._seed(derived.location_map(self.spark, self.sf_dir), "location_map")
        return seeds.read_location_map(self.spark, path)

    @cached_property
    def coordinates(self) -> DataFrame:
        path = self._seed(derived.coordinates(self.spark, self.sf_dir), "coordinates")
        return seeds.read_coordinates(self.spark, path)

    @cached_property
    def bronze(self) -> DataFrame:
        """The derived rows as a Bronze table, one partition per quarter as a load would leave it."""
        rows = derived.derived_bronze(self.spark, self.sf_dir)
        return self.warehouse.write(rows, "bronze", "derived_requests", ["source_quarter"])

    @cached_property
    def layers(self) -> Medallion:
        return Medallion(self.warehouse, self.bronze, self.issue_map, self.location_map, self.contract)

    # ------------------------------------------------------------ release files
    @cached_property
    def releases(self) -> str:
        """Text releases with title, header and data lines; a release holds a bounded run of keys."""
        return self._written("releases", self.bronze)

    @cached_property
    def spanning_releases(self) -> str:
        """The same releases with line ends, quotes and commas inside their cells."""
        return self._written("spanning", derived.with_line_ends(self.bronze))

    def _written(self, name: str, bronze: DataFrame) -> str:
        path = f"{self.warehouse.root}/{name}"
        key = F.col("source_row_number")
        part = F.floor(key / RELEASE_ROWS).cast("string")
        rows = bronze.withColumn("release", F.concat_ws("-", "source_quarter", part))
        fields = F.struct(*[F.col(c) for c in self.contract.column_names])
        data = rows.select("release", key.alias("line"), F.to_csv(fields, PLAIN_CSV).alias("value"))
        top = data.select("release").distinct().select(
            "release",
            F.inline(
                F.array(
                    F.struct(F.lit(-2).cast("long").alias("line"), F.lit("requests").alias("value")),
                    F.struct(F.lit(-1).cast("long").alias("line"), F.lit(",".join(derived.HEADERS)).alias("value")),
                )
            ),
        )
        (
            data.unionByName(top)
            .repartition("release")
            .sortWithinPartitions("release", "line")
            .select("release", "value")
            .write.partitionBy("release")
            .text(path)
        )
        return path

    @staticmethod
    def release_of(path: Column) -> Column:
        return F.regexp_extract(path, r"release=([^/]+)", 1)

    @cached_property
    def release(self) -> Release:
        return read_release(self.spark, self.releases, self.contract)

    @cached_property
    def manifest(self) -> DataFrame:
        """Load all releases; the quarter is read from the release's name."""
        return self.load(self.releases)

    @property
    def quarter_of_file(self) -> Column:
        return F.substring(self.release_of(F.col("source_path")), 1, 6)

    def load(self, path: str) -> DataFrame:
        return load_release(self.warehouse, path, self.quarter_of_file, self.contract)

    @property
    def loaded(self) -> DataFrame:
        self.manifest
        return read_bronze(self.warehouse, self.contract)


_worlds: dict[tuple[str, str], World] = {}


def world(spark: SparkSession, sf_dir: str) -> World:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _worlds:
        _worlds[key] = World(spark, sf_dir)
    return _worlds[key]


def strict_contract():
    """A contract that knows fewer values than the releases hold, so that every warning fires."""
    return replace(
        derived.CONTRACT,
        layouts=(Layout("B", "closure_slot_raw", "^00:00 06:00$", swapped=True), Layout("A")),
        statuses=("done",),
        repeat_flags=("repeated",),
    )


def with_faults(silver: DataFrame) -> DataFrame:
    """Silver with a known fault in some requests, so that each check has something to find."""
    row = F.col("source_row_number")

    def spoil(n: int, column: str, value: Column) -> Column:
        return F.when(row % n == 0, value).otherwise(F.col(column)).alias(column)

    faults = {
        "request_sk": spoil(101, "request_sk", F.lit("same key")),
        "closure_hours": spoil(37, "closure_hours", F.lit(-1.0)),
        "received_date": spoil(41, "received_date", F.date_add("received_date", 100)),
        "time_band": spoil(43, "time_band", F.lit("07:00 08:00")),
        "status_code": spoil(47, "status_code", F.lit("unknown")),
        "repeat_flag_ar": spoil(53, "repeat_flag_ar", F.lit(None).cast("string")),
        "issue_type_ar": spoil(59, "issue_type_ar", F.lit(None).cast("string")),
        "source_layout": spoil(61, "source_layout", F.lit("C")),
    }
    return silver.select(*[faults.get(c, F.col(c)) for c in silver.columns])


def with_gold_faults(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Fact, report, mart and dimensions with repeated keys, keys without a parent, and rows that are gone or doubled."""
    fact, rpt, mart, status = (frames[n] for n in ("fact", "rpt", "mart", "dim_status"))
    start = F.substring("request_sk", 1, 2)

    def spoil(hexes: str, column: str, value: Column) -> Column:
        return F.when(start == hexes, value).otherwise(F.col(column)).alias(column)

    faults = {
        "date_key": spoil("a1", "date_key", F.lit(10101)),
        "issue_key": spoil("b2", "issue_key", F.lit("nothing")),
        "location_key": spoil("c3", "location_key", F.lit("nowhere")),
        "status_code": spoil("d4", "status_code", F.lit("lost")),
    }
    spoiled = fact.select(*[faults.get(c, F.col(c)) for c in fact.columns])
    twice = spoiled.unionByName(spoiled.where(start == "e5"))
    return frames | {
        "fact": twice,
        "rpt": rpt.where(start != "f6"),
        "mart": mart.withColumn("total_requests", F.col("total_requests") + 1),
        "dim_status": status.unionByName(status.where("status_code = 'completed'")),
    }
