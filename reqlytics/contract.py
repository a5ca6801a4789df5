"""The data contract: what a release file must look like, as plain data.

A contract is a small frozen value on the driver. Nothing in it is executed per row in Python;
the functions in this package turn its values into ``isin`` / ``rlike`` column expressions.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from types import MappingProxyType
from typing import Mapping

FAIL, WARN, DROP = REACTIONS = ("fail", "warn", "drop_and_log")
#: Rules about single rows, which alone can be dropped.
ROW_RULES = ("embedded_header_row", "unknown_layout_row", "unknown_status", "unknown_repeat_flag", "unknown_time_band")

# ---- Fixed values: they must equal what the published releases contain -------------------------
ISSUE_HEADERS = ("نوع البلاغ",)
LOCATION_HEADERS = ("الموقع", "اسم الموقع")
STATUS_HEADERS = ("حالة البلاغ",)
CLOSURE_HEADERS = ("زمن الإغلاق بالساعات",)
RECEIVED_HEADERS = ("تاريخ الاستلام",)
REPEAT_HEADERS = ("تكرار البلاغ",)
STATUS_COMPLETED = "تم التنفيذ"
STATUS_IN_PROGRESS = "جاري العمل"
STATUS_NOT_PUBLISHED_LABEL = "غير منشورة"
REPEATED = "مكرر"
NOT_REPEATED = "غير مكرر"
MUNICIPALITY_WORD = "بلدية"
LOCATION_MISSING_LABEL = "غير متوفر في المصدر"
UNMAPPED_LABEL = "غير مصنف"
TIME_BANDS = ("00:00 06:00", "06:00 12:00", "12:00 18:00", "18:00 00:00")
TIME_BAND_PATTERN = r"^\d{2}:\d{2} \d{2}:\d{2}$"
MISSING_KEY_SENTINEL = "__missing__"
HEADER_ROW_INDEX = 1
OUTLIER_HOURS = 720.0
MIN_REQUESTS = 30
PUBLISHED_SHARE = 0.05
# ------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Labels:
    """Words of the source language; every one is a parameter, so other sources can be read."""

    completed: str = STATUS_COMPLETED
    in_progress: str = STATUS_IN_PROGRESS
    not_published: str = STATUS_NOT_PUBLISHED_LABEL
    repeated: str = REPEATED
    not_repeated: str = NOT_REPEATED
    municipality: str = MUNICIPALITY_WORD
    location_missing: str = LOCATION_MISSING_LABEL
    unmapped: str = UNMAPPED_LABEL


@dataclass(frozen=True)
class Column:
    """One required or optional source column and the header texts it is known by."""

    name: str
    aliases: tuple[str, ...]
    required: bool = True


@dataclass(frozen=True)
class Layout:
    """How the two slots are to be read where ``column`` matches ``pattern``; without a pattern: all other rows.

    ``swapped``: the closure slot holds a time band and the status slot the hours.
    """

    name: str
    column: str = ""
    pattern: str = ""
    swapped: bool = False


@dataclass(frozen=True)
class Contract:
    """Columns, layouts, accepted values and the reaction to each kind of problem.

    Layouts are tried in order. Without one that takes all other rows, a row may have none (``unknown_layout_row``).
    """

    columns: tuple[Column, ...] = (
        Column("issue_type_raw", ISSUE_HEADERS),
        Column("location_raw", LOCATION_HEADERS),
        Column("status_slot_raw", STATUS_HEADERS),
        Column("closure_slot_raw", CLOSURE_HEADERS),
        Column("received_raw", RECEIVED_HEADERS),
        Column("repeat_flag_raw", REPEAT_HEADERS),
    )
    header_row: int = HEADER_ROW_INDEX
    expected_columns: int = 6
    layouts: tuple[Layout, ...] = (Layout("B", "closure_slot_raw", TIME_BAND_PATTERN, swapped=True), Layout("A"))
    statuses: tuple[str, ...] = (STATUS_COMPLETED, STATUS_IN_PROGRESS)
    repeat_flags: tuple[str, ...] = (REPEATED, NOT_REPEATED)
    time_bands: tuple[str, ...] = TIME_BANDS
    labels: Labels = field(default_factory=Labels)
    null_tokens: tuple[str, ...] = ("",)
    rules: Mapping[str, str] = field(
        default_factory=lambda: MappingProxyType(
            {
                "missing_required_column": FAIL,
                "unexpected_column": WARN,
                "column_count_mismatch": FAIL,
                "unknown_layout_row": WARN,
                "embedded_header_row": DROP,
                "unknown_status": WARN,
                "unknown_repeat_flag": WARN,
                "unknown_time_band": WARN,
            }
        )
    )

    @property
    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def aliases(self, name: str) -> list[str]:
        return list(next(c for c in self.columns if c.name == name).aliases)

    @property
    def issue_headers(self) -> list[str]:
        return self.aliases("issue_type_raw")


def _layouts(doc: Mapping[str, Mapping]) -> tuple[Layout, ...]:
    """Layouts of a contract document: those with a pattern in the document's order, then the default one."""
    found = [
        Layout(name, spec.get("detect_column", ""), spec.get("detect_pattern", ""), bool(spec.get("slots_swapped", name == "B")))
        for name, spec in doc.items()
    ]
    for layout, spec in zip(found, doc.values()):
        if not layout.pattern and not spec.get("default"):
            raise ValueError(f"layout {layout.name} has neither a pattern nor is it the default")
    return tuple(sorted(found, key=lambda layout: not layout.pattern))


def load_contract(path: str) -> Contract:
    """Read a contract document (JSON, or YAML where a YAML reader is installed).

    Sections: ``file`` (header_row, expected_column_count), ``columns`` (name -> aliases,
    required), ``layouts`` (name -> detect_column, detect_pattern, slots_swapped, or default), ``accepted_values``
    and ``rules``. Whatever a document leaves out keeps the default of :class:`Contract`; a reaction or a rule
    that does not exist is an error.
    """
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith(".json"):
        doc = json.loads(text)
    else:
        try:
            import yaml
        except ImportError as error:  # pragma: no cover - depends on the installation
            raise ValueError("no YAML reader installed: ship the contract as JSON") from error
        doc = yaml.safe_load(text)

    base = Contract()
    rules = {**base.rules, **doc.get("rules", {})}
    for rule, reaction in rules.items():
        if rule not in base.rules or reaction not in REACTIONS or (reaction == DROP and rule not in ROW_RULES):
            raise ValueError(f"rule {rule}: {reaction} is not a reaction to it")
    accepted = doc.get("accepted_values", {})
    statuses = tuple(accepted.get("status_ar", base.statuses))
    flags = tuple(accepted.get("repeat_flag_ar", base.repeat_flags))
    columns = tuple(
        Column(name, tuple(spec["aliases"]), bool(spec.get("required", False)))
        for name, spec in doc.get("columns", {}).items()
    )
    return Contract(
        columns=columns or base.columns,
        header_row=int(doc.get("file", {}).get("header_row", base.header_row)),
        expected_columns=int(doc.get("file", {}).get("expected_column_count", base.expected_columns)),
        layouts=_layouts(doc["layouts"]) if "layouts" in doc else base.layouts,
        statuses=statuses,
        repeat_flags=flags,
        time_bands=tuple(accepted.get("time_band", base.time_bands)),
        labels=Labels(
            completed=statuses[0],
            in_progress=statuses[1] if len(statuses) > 1 else base.labels.in_progress,
            repeated=flags[0],
            not_repeated=flags[1] if len(flags) > 1 else base.labels.not_repeated,
        ),
        rules=MappingProxyType(rules),
    )
