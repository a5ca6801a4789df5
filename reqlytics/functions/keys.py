"""Keys and calendar labels. Each rule exists once, so that fact and dimension cannot drift."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from reqlytics.contract import MISSING_KEY_SENTINEL


def request_key(file_hash: Column, row_number: Column) -> Column:
    """Same file content and same row give the same key, however often the file is loaded."""
    return F.md5(F.concat_ws("-", file_hash, row_number.cast("string")).cast("binary"))


def location_key(location: Column) -> Column:
    return F.md5(F.coalesce(location, F.lit(MISSING_KEY_SENTINEL)).cast("binary"))


def date_key(day: Column) -> Column:
    """``20260131`` by arithmetic: one per request, so no formatter."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("long")


def quarter_code(day: Column) -> Column:
    """``2026Q1``; null for a null day."""
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def issue_quarter_key(quarter: Column, issue_key: Column) -> Column:
    return F.concat(quarter, F.lit("-"), issue_key)
