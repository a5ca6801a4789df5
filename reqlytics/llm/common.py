"""What the operators share: reading tables, written intermediate results, row functions over Arrow."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from reqlytics.sources.warehouse import materialise

__all__ = ["table", "materialise", "mapped", "with_columns", "with_replaced", "chosen", "by_hash", "free_name"]

#: Rows of a batch that are worked on at once: results of long texts do not pile up.
ROWS = 2000

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package's code to every executor, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="reqlytics-code-")  # the driver's; Spark serves the file from here
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/{package.name}-code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def mapped(df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with the package's code at hand on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(rows, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` is called so (letter case ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_columns(
    df: DataFrame,
    inputs: dict[str, Column | str],
    keep: list[str],
    added: T.StructType,
    compute: Callable[[pa.RecordBatch], dict[str, list | pa.Array]],
    start: Callable[[], None] | None = None,
) -> DataFrame:
    """``keep`` of each row, with columns that ``compute`` makes from a batch of ``inputs``.

    One value per row, in order; no row is added or lost, nothing is shuffled. Only the named columns leave
    the JVM, so other columns of any name do no harm. An input that is the name of a kept column is sent once.
    """
    kept = [df[f"`{c}`"].alias(f"k{i}") for i, c in enumerate(keep)]
    fields = [T.StructField(f"k{i}", df.schema[c].dataType) for i, c in enumerate(keep)]
    schema = T.StructType(fields + list(added.fields))
    names = list(inputs)
    width = len(keep)
    places, sent = [], []
    for c in inputs.values():
        if isinstance(c, str) and c in keep:
            places.append(keep.index(c))
        else:
            places.append(width + len(sent))
            sent.append((df[f"`{c}`"] if isinstance(c, str) else c).alias(f"i{len(sent)}"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np  # noqa: F401  loaded once per worker

        if start is not None:
            start()
        types = None
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            seen = pa.RecordBatch.from_arrays([batch.columns[i] for i in places], names=names)
            made = compute(seen)
            if types is None:
                from pyspark.sql.pandas.types import to_arrow_type

                types = [to_arrow_type(f.dataType) for f in added.fields]
            columns = [
                made[f.name] if isinstance(made[f.name], pa.Array) else pa.array(made[f.name], kind)
                for f, kind in zip(added.fields, types)
            ]
            columns = [c if c.type == kind else c.cast(kind) for c, kind in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *columns], names=schema.names)
            del batch, seen, made, columns
        pa.default_memory_pool().release_unused()  # a worker lives on; what it no longer needs goes back

    given = df.select(*kept, *sent)
    out = mapped(given, rows, schema)
    return out.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *[F.col(f.name) for f in added.fields]
    )


def with_replaced(
    df: DataFrame, column: str, compute: Callable[[pa.RecordBatch], dict[str, list | pa.Array]], extra: T.StructType | None = None
) -> DataFrame:
    """``df`` with ``column`` taken from what ``compute`` returns as "new"; columns in ``extra`` come after."""
    names = {c: f"d{i}" for i, c in enumerate(df.columns)}
    plain = df.select(*[df[f"`{c}`"].alias(n) for c, n in names.items()])
    added = T.StructType([T.StructField("new", df.schema[column].dataType), *(extra.fields if extra else [])])
    others = [n for c, n in names.items() if c != column]
    made = with_columns(plain, {"value": names[column]}, others, added, compute)
    kept = [F.col("new" if c == column else n).alias(c) for c, n in names.items()]
    return made.select(*kept, *[F.col(f.name) for f in (extra.fields if extra else [])])


def by_hash(*columns: Column) -> Column:
    """An order that has nothing to do with the rows' places: for bounded samples."""
    return F.xxhash64(*columns)


def chosen(df: DataFrame, key: str, n: int) -> DataFrame:
    """At most ``n`` rows, the same on every run: a bounded sample to fit a classifier on.

    Rows are first thinned to about ``2 n`` by their key's hash, so the sort that settles the rest sees a few
    rows per task, however many tasks there are. Where one key holds many rows, the sample may be smaller.
    """
    total = df.count()
    if not total:
        return df
    of = 1 << 62
    share = min(of, 2 * n * of // total + 1)
    thin = df.where(F.pmod(by_hash(F.col(key)), F.lit(of)) < share) if share < of else df
    return thin.orderBy(by_hash(F.col(key)), F.col(key)).limit(n)
