"""Row rules of the contract as column expressions, and the log of the rows they drop.

All rules are tagged in one pass. What a rule that is broken leads to is the contract's choice: ``fail`` refuses the
file, ``warn`` reports it, and ``drop_and_log`` keeps the row out of Silver and writes it to the quarantine table with
its row number and rule. Bronze holds every row as stored in any case.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from reqlytics.contract import DROP, Contract
from reqlytics.functions.text import is_header_text, is_swapped, layout_of, strip

Cell = Callable[[str], Column]


@dataclass(frozen=True)
class RowRule:
    """Where a rule is ``broken`` (never null), and the ``value`` that breaks it."""

    name: str
    broken: Column
    value: Column


def row_rules(contract: Contract, cell: Cell, embedded: Column) -> list[RowRule]:
    """The rules over cleaned cells. Rows that are headers or empty break no rule about values."""
    is_data = ~embedded & F.coalesce(*[cell(c) for c in contract.column_names]).isNotNull()
    layout = layout_of(cell, contract.layouts)
    swapped = is_swapped(layout, contract.layouts)
    status, flag, band = cell("status_slot_raw"), cell("repeat_flag_raw"), cell("closure_slot_raw")

    def known(value: Column, values: tuple[str, ...]) -> Column:
        return F.coalesce(value.isin(list(values)), F.lit(False))

    in_place = layout.isNotNull() & ~swapped & status.isNotNull()
    return [
        RowRule("embedded_header_row", embedded, cell("issue_type_raw")),
        RowRule("unknown_layout_row", is_data & layout.isNull(), band),
        RowRule("unknown_status", is_data & in_place & ~known(status, contract.statuses), status),
        RowRule("unknown_repeat_flag", is_data & ~known(flag, contract.repeat_flags), flag),
        RowRule("unknown_time_band", is_data & swapped & ~known(band, contract.time_bands), band),
    ]


def stored_rules(contract: Contract) -> list[RowRule]:
    """The rules over Bronze as stored. A header is what Silver takes for one: its text, however it is spaced."""
    embedded = is_header_text(F.col("issue_type_raw"), contract.issue_headers)
    return row_rules(contract, lambda c: strip(F.col(c)), embedded)


def dropped(contract: Contract) -> Column:
    """True for the rows of Bronze that the contract keeps out of Silver."""
    hits = [r.broken for r in stored_rules(contract) if contract.rules.get(r.name) == DROP]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def quarantine(bronze: DataFrame, contract: Contract = Contract()) -> DataFrame:
    """A row per dropped row and rule: where it stands, the rule, and the value that broke it."""
    hits = [
        F.when(r.broken, F.struct(F.lit(r.name).alias("rule"), r.value.alias("value")))
        for r in stored_rules(contract)
        if contract.rules.get(r.name) == DROP
    ]
    kind = "array<struct<rule: string, value: string>>"
    broken = F.array_compact(F.array(*hits)).cast(kind) if hits else F.array().cast(kind)
    lineage = ["source_quarter", "source_file", "file_sha256", "batch_id", "source_row_number"]
    return bronze.select(*lineage, F.inline(broken))
