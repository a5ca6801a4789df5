"""Bronze to Gold: every layer written as a table and checked before the next one is built."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from reqlytics.contract import MIN_REQUESTS, Contract
from reqlytics.plans import dimensions, fact, kpis, performance, quality, silver
from reqlytics.sources.warehouse import Warehouse


@dataclass
class Medallion:
    """Layer tables, each built on first use, written once and read back for everything after it.

    Silver, fact, reporting table and mart are partitioned by quarter, so a period filter prunes files, and
    :meth:`refresh` builds only the quarters that were loaded again.
    """

    warehouse: Warehouse
    bronze: DataFrame
    issue_map: DataFrame
    location_map: DataFrame
    contract: Contract = Contract()
    min_requests: int = MIN_REQUESTS

    #: Quarters to build; None: all of them.
    changed: frozenset[str] | None = None

    def _by_quarter(self, df: DataFrame, layer: str, name: str) -> DataFrame:
        # one shuffle-free write: each task writes the quarters it holds
        if self.changed is None:
            return self.warehouse.write(df, layer, name, ["source_quarter"])
        return self.warehouse.replace_partitions(df, layer, name, "source_quarter", sorted(self.changed))

    def _all_quarters(self, frame: DataFrame, layer: str, name: str) -> DataFrame:
        """A table of all quarters where only some were built."""
        return frame if self.changed is None else self.warehouse.read(layer, name, frame.schema).select(*frame.columns)

    @cached_property
    def source(self) -> DataFrame:
        return self.bronze if self.changed is None else self.bronze.where(F.col("source_quarter").isin(sorted(self.changed)))

    @cached_property
    def silver(self) -> DataFrame:
        return self._by_quarter(silver.build_silver(self.source, self.contract), "silver", "service_requests")

    @cached_property
    def places(self) -> DataFrame:
        """What the dimensions need of Silver, per quarter: its places, with their first and last date."""
        frame = dimensions.silver_places(self.silver)
        return self._all_quarters(self._by_quarter(frame, "silver", "places"), "silver", "places")

    @cached_property
    def dim_date(self) -> DataFrame:
        dates = self.places.select(F.explode(F.array("first_date", "last_date")).alias("received_date"))
        return self.warehouse.write(dimensions.build_dim_date(dates), "gold", "dim_date")

    @cached_property
    def dim_issue(self) -> DataFrame:
        frame = dimensions.build_dim_issue(self.issue_map, self.contract)
        return self.warehouse.write(frame, "gold", "dim_issue")

    @cached_property
    def dim_location(self) -> DataFrame:
        frame = dimensions.build_dim_location(self.places, self.location_map, self.contract)
        return self.warehouse.write(frame, "gold", "dim_location")

    @cached_property
    def dim_status(self) -> DataFrame:
        frame = dimensions.build_dim_status(self.warehouse.spark, self.contract)
        return self.warehouse.write(frame, "gold", "dim_status")

    @cached_property
    def fact(self) -> DataFrame:
        return self._by_quarter(fact.build_fact(self.silver, self.issue_map), "gold", "fact_requests")

    @cached_property
    def rpt(self) -> DataFrame:
        frame = fact.build_report(self.fact, self.dim_date, self.dim_issue, self.dim_location, self.dim_status)
        return self._by_quarter(frame, "gold", "rpt_requests")

    @cached_property
    def hours(self) -> DataFrame:
        """Counts from which headline figures of any set of periods follow."""
        return self._by_quarter(kpis.hour_counts(self.rpt), "gold", "hour_counts")

    @cached_property
    def mart(self) -> DataFrame:
        frame = performance.build_issue_performance(self.fact, self.dim_issue, self.min_requests)
        return self._by_quarter(frame, "gold", "issue_performance")

    def build(self, *names: str) -> None:
        """Build layers that do not depend on each other at the same time.

        Small layers leave most of a cluster idle; submitted together their jobs fill it.
        """
        with ThreadPoolExecutor(len(names)) as pool:
            for done in [pool.submit(getattr, self, name) for name in names]:
                done.result()

    def tables(self, *names: str) -> quality.Tables:
        return quality.Tables({n: self.source if n == "bronze" else getattr(self, n) for n in names})

    def run(self, stop: bool = True) -> list:
        """Build all layers in order; a failing check stops before the next layer is built.

        With ``stop=False`` all layers are built and all check rows returned, whatever they say.
        """
        dims = ("dim_date", "dim_issue", "dim_location", "dim_status")
        stages = (
            (quality.seed_checks(), ("issue_map", "location_map"), ()),
            (quality.silver_checks(self.contract), ("bronze", "silver", "issue_map", "location_map"), ("silver",)),
            (quality.dimension_checks(), dims, dims),
            (quality.fact_checks(), ("fact", *dims), ("fact",)),
            (quality.mart_checks(), ("fact", "mart", "rpt"), ("rpt", "mart")),
        )
        rows = []
        for checks, names, first in stages:
            if first == dims:
                self.places  # two dimensions share it
            if first:
                self.build(*first)
            results = quality.run_checks(self.tables(*names), checks, self.contract)
            rows += quality.gate(results, checks) if stop else results.collect()
        self.hours
        return rows

    # ------------------------------------------------------------ rebuild of what changed
    @property
    def _state(self) -> str:
        return self.warehouse.path("gold", "_built")

    def settings(self) -> str:
        """A digest of all that every quarter depends on: the contract, the lookups and the limits."""
        def digest(frame: DataFrame) -> str:
            hashed = F.xxhash64(*[F.col(c).cast("string") for c in frame.columns]).cast("decimal(38,0)")
            row = frame.agg(F.count(F.lit(1)).alias("n"), F.sum(hashed).alias("h")).first()
            return f"{frame.columns} {row['n']} {row['h']}"

        contract = {**vars(self.contract), "rules": sorted(self.contract.rules.items())}
        text = repr((sorted(contract.items()), self.min_requests, digest(self.issue_map), digest(self.location_map)))
        return hashlib.sha256(text.encode()).hexdigest()

    def built_from(self) -> dict[str, tuple[str, str]]:
        """The Bronze batch that each quarter was last built from, and the run that did; empty before the first run."""
        spark, place = self.warehouse.spark, self.warehouse.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._state)
        if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
            return {}
        rows = spark.read.schema("quarter string, batch_id string, run_id string, settings string").json(self._state).collect()
        settings = self.settings()
        return {r["quarter"]: (r["batch_id"], r["run_id"]) for r in rows if r["settings"] == settings}

    def refresh(self, batches: Mapping[str, str], stop: bool = True) -> list:
        """Build the quarters whose batch is not the one they were built from, and leave all others alone.

        ``batches`` names the Bronze batch of each quarter (``bronze_table(warehouse).current()``). With another contract,
        other lookups or limits, and on the first run, everything is built. What was built is noted last, so a
        run that fails or is lost builds the same quarters again. Checks look at the quarters that were built.
        """
        known = self.built_from()
        run_id = uuid.uuid4().hex[:12]
        changed = {q for q in {*known, *batches} if known.get(q, ("",))[0] != batches.get(q)}
        if known and not changed:
            return []
        job = replace(self, changed=frozenset(changed) if known else None)
        rows = job.run(stop)
        state = {q: (b, run_id if q in changed else known[q][1]) for q, b in batches.items()}
        settings = self.settings()
        noted = [(q, b, run, settings) for q, (b, run) in sorted(state.items())]
        schema = "quarter string, batch_id string, run_id string, settings string"
        self.warehouse.spark.createDataFrame(noted, schema).coalesce(1).write.mode("overwrite").json(self._state)
        return rows
