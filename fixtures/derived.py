"""Service-request releases derived from ``orders``, ``customer`` and ``nation``.

Every order becomes one request: all rows of the tables are used. The arithmetic on keys only
decides *what a request looks like* (missing place, text instead of hours, repeated header, ...),
so that each rule of the cleaning is met by real rows. ``fixtures/oracle.py`` states the same
derivation in SQL.
"""

from __future__ import annotations

from dataclasses import replace
from types import MappingProxyType

from pyspark.sql import Window, Column, DataFrame, SparkSession, functions as F

from reqlytics.contract import Column as Field, Contract, Labels, Layout

HEADER_WORD = "issue_type"
LOCATION_MISSING = "NOT IN SOURCE"
LABELS = Labels(
    completed="done",
    in_progress="in progress",
    not_published="status not published",
    repeated="repeated",
    not_repeated="not repeated",
    municipality="MUNICIPALITY",
    location_missing=LOCATION_MISSING,
    unmapped="not classified",
)
HEADERS = [HEADER_WORD, "location", "status", "closure_hours", "received", "repeat"]
CONTRACT = Contract(
    columns=(
        Field("issue_type_raw", (HEADER_WORD,)),
        Field("location_raw", ("location", "location_name")),
        Field("status_slot_raw", ("status",)),
        Field("closure_slot_raw", ("closure_hours",)),
        Field("received_raw", ("received",)),
        Field("repeat_flag_raw", ("repeat",)),
    ),
    statuses=(LABELS.completed, LABELS.in_progress),
    repeat_flags=(LABELS.repeated, LABELS.not_repeated),
    labels=LABELS,
)
LAYOUT_CHANGE = "1998-05-15"
BANDS = ["00:00 06:00", "06:00 12:00", "12:00 18:00", "18:00 00:00"]
INGESTED_AT = "2026-10-07 07:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def every(n: int, key: Column) -> Column:
    return key % n == 0


def derived_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    homes = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("o_custkey"), "n_name")
    )
    k, u = F.col("o_orderkey"), F.col("o_custkey")
    day = F.to_date("o_orderdate")
    in_b = (day >= F.lit(LAYOUT_CHANGE).cast("date")) & ~every(50, k)
    hours = (
        F.when(every(173, k), F.lit(None))
        .when(every(211, k), "0")
        .when(every(223, k), "n/a")
        .otherwise(F.floor(F.col("o_totalprice") / 500).cast("string"))
    )
    kind = (u % 4).cast("string")
    issue = (
        F.when(every(1999, k), HEADER_WORD)
        .when(
            every(7, k),
            F.concat(
                F.lit("  "), F.replace(F.col("o_orderpriority"), F.lit("-"), F.lit(" ")), F.lit("   type "), kind
            ),
        )
        .otherwise(F.concat(F.col("o_orderpriority"), F.lit(" type "), kind))
    )
    place = (
        F.when(every(97, k), F.lit(None))
        .when(every(89, k), "UNSPECIFIED")
        .when(every(83, k), "MUNICIPALITY")
        .when(every(79, k), F.concat(F.lit("MUNICIPALITY "), F.col("n_name")))
        .otherwise(F.concat(F.col("n_name"), F.lit(" ")))
    )
    band = F.element_at(F.array(*[F.lit(b) for b in BANDS]), (u % 4 + 1).cast("int"))
    quarter = F.format_string("%dQ%d", F.year(day), F.quarter(day))
    shown = F.date_format(day, "yyyy-MM-dd")
    clock = F.concat(shown, F.lit(" "), F.lpad((k % 24).cast("string"), 2, "0"), F.lit(":00:00"))
    return (
        orders.join(homes, "o_custkey")
        .withColumn("source_quarter", quarter)
        .select(
            (k + 3).alias("source_row_number"),
            issue.alias("issue_type_raw"),
            place.alias("location_raw"),
            F.when(in_b, hours)
            .when(F.col("o_orderstatus") == "O", "in progress")
            .otherwise(" done ")
            .alias("status_slot_raw"),
            F.when(in_b, band).otherwise(hours).alias("closure_slot_raw"),
            F.when(in_b, shown).otherwise(clock).alias("received_raw"),
            F.when(u % 3 == 0, "repeated").otherwise(" not repeated").alias("repeat_flag_raw"),
            F.concat(F.lit("req_"), "source_quarter", F.lit(".csv")).alias("source_file"),
            "source_quarter",
            F.sha2("source_quarter", 256).alias("file_sha256"),
            F.lit("derived").alias("batch_id"),
            F.lit(INGESTED_AT).cast("timestamp").alias("ingested_at"),
        )
    )


def issue_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both spellings of every issue, but for one spelling that is left out on purpose."""
    canonical = (
        table(spark, sf_dir, "orders")
        .select("o_orderpriority")
        .distinct()
        .select("o_orderpriority", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("kind"))
    )
    name = F.concat(F.col("o_orderpriority"), F.lit(" type "), F.col("kind").cast("string"))
    digit = F.substring("o_orderpriority", 1, 1)
    spellings = F.array(F.struct(name.alias("text")), F.struct(F.replace(name, F.lit("-"), F.lit(" ")).alias("text")))
    return (
        canonical.select(F.explode(spellings).alias("s"), digit.alias("d"), name.alias("name"), "kind")
        .where(~((F.col("name") == "5-LOW type 3") & (F.col("s.text") != F.col("name"))))
        .select(
            F.col("s.text").alias("issue_type_ar"),
            F.concat(F.lit("I"), "d", F.col("kind").cast("string")).alias("issue_code"),
            F.concat(F.lit("ar "), "name").alias("issue_ar"),
            F.col("name").alias("issue_en"),
            F.lit("dept ar").alias("department_ar"),
            F.lit("Operations").alias("department_en"),
            F.concat(F.lit("ar domain "), "d").alias("domain_ar"),
            F.concat(F.lit("domain "), "d").alias("domain_en"),
            F.lit("derived").alias("translation_source"),
        )
    )


UNMAPPED_NATION = 7


def location_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place but one nation's municipality, which stays unknown on purpose."""
    nations = table(spark, sf_dir, "nation").select("n_name", "n_nationkey")

    def kind(location: Column, name: Column, type_: str) -> Column:
        return F.struct(
            location.alias("location_ar"),
            location.alias("location_label_ar"),
            name.alias("location_en"),
            F.lit(type_).alias("location_type"),
            F.lit(f"ar {type_}").alias("location_type_ar"),
            F.lit(type_).alias("location_type_en"),
        )

    n = F.col("n_name")
    municipality = F.concat(F.lit("MUNICIPALITY "), n)
    places = F.array(
        kind(n, F.lower(n), "neighborhood"), kind(municipality, F.lower(municipality), "municipality")
    )
    known = F.when(F.col("n_nationkey") == UNMAPPED_NATION, F.slice(places, 1, 1)).otherwise(places)
    per_nation = nations.select(F.inline(known))
    special = spark.range(1).select(
        F.inline(
            F.array(
                kind(F.lit("MUNICIPALITY"), F.lit("municipality"), "generic_municipality"),
                kind(F.lit("UNSPECIFIED"), F.lit("unspecified"), "unspecified"),
                kind(F.lit(LOCATION_MISSING), F.lit("not in source"), "missing"),
            )
        )
    )
    return per_nation.unionByName(special)


def coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the places have a position; the others cannot be put on a map."""
    key = F.col("n_nationkey")
    position = F.when(key % 2 == 0, key.cast("double"))
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("location_label"), position.alias("lat"), (position * 2).alias("lon")
    )


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(release, line, value)`` of one small release per nation, with a row per customer and a fault that
    depends on the nation: 1 title only, 2 a wider row, 3 a quote without end, 4 a column missing, 5 header only."""
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_nationkey").alias("release"),
        F.col("c_custkey").alias("line"),
        (F.col("c_nationkey") % 6).alias("fault"),
        (F.col("c_custkey") == F.min("c_custkey").over(Window.partitionBy("c_nationkey"))).alias("is_first"),
    )
    fault, first = F.col("fault"), F.col("is_first")
    body = F.concat(F.lit("Lamp,place "), F.col("release"), F.lit(",done,5,1998-01-01"))
    value = (
        F.when(fault == 4, body)
        .when((fault == 2) & first, F.concat(body, F.lit(",repeated,more")))
        .when((fault == 3) & first, F.concat(F.lit('"two\nlines,place,done,5,1998-01-01,repeated')))
        .otherwise(F.concat(body, F.lit(",repeated")))
    )
    data = rows.where(~fault.isin(1, 5)).select("release", "line", value.alias("value"))
    nations = rows.where(first)
    header = F.when(fault == 4, "issue_type,location,status,closure_hours,received").otherwise(
        "issue_type,location,status,closure_hours,received,repeat"
    )
    titles = nations.select("release", F.lit(-2).alias("line"), F.lit("requests").alias("value"))
    headers = nations.where(fault != 1).select("release", F.lit(-1).alias("line"), header.alias("value"))
    return titles.unionByName(headers).unionByName(data)


def sparse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(release, line, value)`` of a release per nation with a line per customer: each fifth is empty cells, each seventh
    of the others repeats the header."""
    key = F.col("c_custkey")
    header = ",".join(HEADERS)
    value = F.when(key % 5 == 0, ",,,,,").when(key % 7 == 0, header).otherwise(
        F.concat(F.lit("Lamp,place "), "c_nationkey", F.lit(",done,"), (key % 90).cast("string"), F.lit(",1998-01-01,repeated"))
    )
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("release"), key.alias("line"), value.alias("value"))
    top = rows.select("release").distinct()
    titles = top.select("release", F.lit(-2).alias("line"), F.lit("requests").alias("value"))
    return rows.unionByName(titles).unionByName(top.select("release", F.lit(-1).alias("line"), F.lit(header).alias("value")))


def with_line_ends(rows: DataFrame) -> DataFrame:
    """Bronze rows whose places and flags hold line ends, quotes and commas in some requests."""
    row = F.col("source_row_number")
    more = F.concat(F.coalesce("location_raw", F.lit("")), F.lit('\n"near",\n\nno. '), row.cast("string"))
    flag = F.concat(F.lit("\n"), F.col("repeat_flag_raw"))
    return rows.withColumn("location_raw", F.when(every(3, row), more).otherwise(F.col("location_raw"))).withColumn(
        "repeat_flag_raw", F.when(every(7, row), flag).otherwise(F.col("repeat_flag_raw"))
    )


# contract whose layouts leave rows over: hours that are no number belong to neither
NO_DEFAULT = (
    Layout("B", "closure_slot_raw", r"^\d{2}:\d{2} \d{2}:\d{2}$", swapped=True),
    Layout("A", "closure_slot_raw", r"^\d+$"),
)


def contract_with(reaction: str) -> Contract:
    """One reaction to repeated headers, rows of no layout and unknown time bands alike."""
    rules = {"embedded_header_row": reaction, "unknown_layout_row": reaction, "unknown_time_band": reaction}
    return replace(
        CONTRACT, layouts=NO_DEFAULT, time_bands=tuple(BANDS[1:]), rules=MappingProxyType({**CONTRACT.rules, **rules})
    )
