"""Cell-level rules on hand-made values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from reqlytics.contract import LOCATION_MISSING_LABEL, Contract
from reqlytics.functions import casts, keys, labels, text


@pytest.fixture(scope="module")
def apply(spark):
    def run(function, values, type_="string"):
        frame = spark.createDataFrame(list(enumerate(values)), f"i int, c {type_}")
        return [r[0] for r in frame.orderBy("i").select(function(F.col("c"))).collect()]

    return run


def test_strip_removes_every_kind_of_space(apply):
    given = ["\ta ", " b ", " c d　", "", None, " "]
    assert apply(text.strip, given) == ["a", "b", "c d", "", None, ""]


def test_squeeze_collapses_runs(apply):
    given = ["  a \t\n b  ", "a  b", "a b", None]
    assert apply(text.squeeze, given) == ["a b", "a b", "a b", None]


def test_match_key_ignores_marks(apply):
    assert apply(text.match_key, ["a-b (c)", "a b/c", "abc"]) == ["abc"] * 3


def test_header_text_is_null_safe(apply):
    found = apply(lambda c: text.is_header_text(c, ["issue type"]), [" issue  type ", "issue type 3", None])
    assert found == [True, False, False]


def test_layout_needs_ascii_digits(apply):
    given = ["06:00 12:00", "06:00  12:00", "٠٦:٠٠ ١٢:٠٠", "5", None]
    assert apply(lambda c: text.is_swapped(text.layout_of(lambda _: c, Contract().layouts), Contract().layouts), given) == [True, False, False, False, False]


def test_safe_double(apply):
    given = ["5.", ".5", "1e3", "+5", "-2", "1d", "1f", "1_000", "٥", "n/a", "", "0x1p3", None]
    want = [5.0, 0.5, 1000.0, 5.0, -2.0] + [None] * 8
    assert apply(casts.safe_double, given) == want
    nan, inf = apply(casts.safe_double, ["nan", "Infinity"])
    assert math.isnan(nan) and math.isinf(inf)


def test_safe_datetime(apply):
    bad = ["2026", "2026-06", "2026-01-01 10:00", "2026-01-01 10:00:00+03:00", "2026-13-01", "x", None]
    assert apply(casts.safe_datetime, bad) == [None] * len(bad)
    good = apply(casts.safe_datetime, ["2026-06-30", "2026-6-3 1:2:3", "2026-06-03t01:02:03.5"])
    assert good == [
        dt.datetime(2026, 6, 30),
        dt.datetime(2026, 6, 3, 1, 2, 3),
        dt.datetime(2026, 6, 3, 1, 2, 3, 500000),
    ]


def test_missing_location_has_its_own_key(apply):
    missing, shown = apply(keys.location_key, [None, LOCATION_MISSING_LABEL])
    assert missing != shown and len(missing) == 32


def test_quarter_and_date_key(apply):
    days = [dt.date(2026, 1, 1), dt.date(2026, 6, 30), None]
    assert apply(keys.quarter_code, days, "date") == ["2026Q1", "2026Q2", None]
    assert apply(keys.date_key, days, "date") == [20260101, 20260630, None]


def test_labels(spark):
    codes = spark.createDataFrame([("2026Q1", "2026Q2"), ("2025Q4", "2026Q1")], "a string, b string")
    en = [r[0] for r in codes.select(labels.period_label(F.col("a"), F.col("b"))).collect()]
    assert en == ["Jan – Jun 2026", "Oct 2025 – Mar 2026"]
    ar = codes.select(labels.period_label(F.col("a"), F.col("b"), "ar")).first()[0]
    assert ar == "يناير – يونيو 2026"
    month = spark.range(1).select(labels.month_label(F.lit("2026-04")), labels.month_label(F.lit("2026-04"), "ar"))
    assert tuple(month.first()) == ("Apr 2026", "أبريل 2026")
    ranks = spark.createDataFrame([(g,) for g in labels.GROUPS], "g string").select(labels.review_rank(F.col("g")))
    assert [r[0] for r in ranks.collect()] == [3, 1, 2, 0, None]
