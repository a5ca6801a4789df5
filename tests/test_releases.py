"""Release files: validation, row numbers, load, manifest. Text files and workbooks alike."""

import collections
import csv
import hashlib
import io
import random
import subprocess
import sys
import zipfile
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from xml.sax.saxutils import escape

from reqlytics.contract import TIME_BAND_PATTERN, Contract, Layout, load_contract
from reqlytics.plans import load as loading
from reqlytics.plans.load import (
    ReleaseRejected, bronze_table, load_release, read_bronze, read_dropped, read_manifest,
)
from reqlytics.plans.silver import build_silver
from reqlytics.plans.validation import failing_files, validate_files
from reqlytics.sources import records, releases
from reqlytics.sources.warehouse import RowCounts, Warehouse
from reqlytics.sources.workbook import sheet_rows

HEADERS = ["نوع البلاغ", "الموقع", "حالة البلاغ", "زمن الإغلاق بالساعات", "تاريخ الاستلام", "تكرار البلاغ"]
ROW_A = ["حاوية ممتلئة", "النرجس", "تم التنفيذ", "5", "2026-01-01 10:00:00", "مكرر"]
ROW_B = ["إنارة مطفأة", "طويق", "3", "18:00 00:00", "2026-06-30", "غير مكرر"]


def as_text(rows):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n").writerows([["" if c is None else c for c in r] for r in rows])
    return out.getvalue().encode()


def as_workbook(rows):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    shared, body = [], []
    for i, row in enumerate(rows, 1):
        cells = ""
        for j, value in enumerate(row):
            ref = f"{chr(65 + j)}{i}"
            if value is None:
                continue
            if isinstance(value, (int, float)):
                cells += f'<c r="{ref}"><v>{value}</v></c>'
            elif isinstance(value, tuple):
                cells += f'<c r="{ref}" s="1"><v>{value[0]}</v></c>'
            elif j % 2:
                cells += f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'
            else:
                shared.append(value)
                cells += f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>'
        if cells:
            body.append(f'<row r="{i}">{cells}</row>')
    parts = {
        "xl/workbook.xml": f'<workbook {ns} xmlns:r="{rel}"><sheets><sheet name="2026" sheetId="1" r:id="rId9"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        f'<Relationship Id="rId9" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {ns}>" + "".join(f"<si><t>{escape(s)}</t></si>" for s in shared) + "</sst>",
        "xl/styles.xml": f'<styleSheet {ns}><cellXfs><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f"<worksheet {ns}><sheetData>{''.join(body)}</sheetData></worksheet>",
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        for name, content in parts.items():
            book.writestr(name, content)
    return out.getvalue()


@pytest.fixture(params=["csv", "xlsx"])
def make_file(request, tmp_path):
    def build(headers, rows, name="release"):
        path = tmp_path / f"{name}.{request.param}"
        everything = [["title"] + [None] * (len(headers) - 1), headers, *rows]
        path.write_bytes(as_text(everything) if request.param == "csv" else as_workbook(everything))
        return str(path)

    return build


def report_of(spark, path):
    return validate_files(spark, path).first()


def test_layout_a_passes(spark, make_file):
    r = report_of(spark, make_file(HEADERS, [ROW_A]))
    assert (r["status"], r["layout_a"], r["layout_b"], r["data_rows"]) == ("pass", 1, 0, 1)


def test_layout_b_is_detected(spark, make_file):
    r = report_of(spark, make_file(HEADERS, [ROW_A, ROW_B]))
    assert (r["layout_a"], r["layout_b"]) == (1, 1)


def test_second_location_header_is_accepted(spark, make_file):
    r = report_of(spark, make_file([HEADERS[0], " اسم الموقع ", *HEADERS[2:]], [ROW_A]))
    assert r["status"] == "pass"


def test_missing_column_fails_before_rows(spark, make_file):
    r = report_of(spark, make_file(HEADERS[:5], [ROW_A[:5]]))
    assert r["status"] == "fail" and r["data_rows"] is None
    assert any("repeat_flag_raw" in e for e in r["errors"]) and len(r["errors"]) == 2


def test_extra_column_warns_and_fails_on_count(spark, make_file):
    r = report_of(spark, make_file([*HEADERS, "x, y"], [[*ROW_A, "z"]]))
    assert r["status"] == "fail" and "x, y" in r["warnings"][0]


def test_same_column_twice_fails(spark, make_file):
    r = report_of(spark, make_file(["الموقع", "اسم الموقع", *HEADERS[2:]], [ROW_A]))
    assert r["status"] == "fail" and "issue_type_raw" in r["errors"][0]


def test_embedded_header_and_empty_rows(spark, make_file):
    r = report_of(spark, make_file(HEADERS, [ROW_A, HEADERS, [None] * 6, ROW_A]))
    assert (r["embedded_header_rows"], r["empty_rows"], r["data_rows"], r["rows_in_file"]) == (1, 1, 2, 4)


def test_unknown_values_warn_in_order_of_appearance(spark, make_file):
    rows = [[*ROW_A[:2], s, *ROW_A[3:5], f] for s, f in zip("gcgbafe", ["مكرر", None, "q", "مكرر", "p", None, "مكرر"])]
    r = report_of(spark, make_file(HEADERS, rows))
    assert r["status"] == "pass_with_warnings"
    assert (r["invalid_status_in_layout_a"], r["status_examples"]) == (7, list("gcbaf"))
    assert (r["invalid_repeat_flag"], r["repeat_flag_examples"]) == (4, [None, "q", "p"])


def test_null_closure_is_layout_a_and_null_status_is_not_unknown(spark, make_file):
    r = report_of(spark, make_file(HEADERS, [[*ROW_A[:2], None, None, *ROW_A[4:]]]))
    assert (r["status"], r["layout_a"]) == ("pass", 1)


def test_several_files_one_report_each(spark, tmp_path):
    for name, headers in (("a", HEADERS), ("b", HEADERS[:5]), ("c", HEADERS[::-1])):
        row = dict(zip(HEADERS, ROW_A))
        content = [["t"], headers, [row[h] for h in headers]]
        (tmp_path / f"{name}.csv").write_bytes(as_text(content))
    report = validate_files(spark, str(tmp_path))
    assert {r["source_path"][-5:-4]: r["status"] for r in report.collect()} == {"a": "pass", "b": "fail", "c": "pass"}
    assert [r.source_path[-5:] for r in failing_files(report).collect()] == ["b.csv"]


def test_workbook_cells_are_text():
    rows = [["a", 5, 5.5, (46023.4166666667,), None, "z"], [], [None, "q"]]
    got = list(sheet_rows(as_workbook(rows)))
    assert got == [(1, ["a", "5", "5.5", "2026-01-01 10:00:00", None, "z"]), (3, [None, "q"])] or got == [
        (1, ["a", "5", "5.5", "2026-01-01 10:00:00", None, "z"]), (2, []), (3, [None, "q"])
    ]


def test_row_numbers_survive_splits(spark, tmp_path):
    sizes = {"one": 5000, "two": 1, "three": 777}
    for name, n in sizes.items():
        lines = [f"{name} {i}" if i % 50 else "" for i in range(1, n + 1)]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = releases.numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == sum(sizes.values())
    for r in rows:
        name = r["source_path"].rsplit("/", 1)[1][:-4]
        i = r["source_row_number"]
        assert r["value"] == (f"{name} {i}" if i % 50 else "")


def test_cells_keep_quotes_and_null_tokens(spark, tmp_path):
    row = ['say "hi", you', " x ", "NA", "", "2026-01-01", "مكرر"]
    (tmp_path / "r.csv").write_bytes(as_text([["t"], HEADERS, row]))

    def cells(contract):
        release = releases.read_release(spark, str(tmp_path), contract)
        placed = releases.map_headers(release.headers, contract)
        return list(releases.mapped_rows(release, placed, contract).first())[1:]

    assert cells(Contract()) == [3, 'say "hi", you', " x ", "NA", None, "2026-01-01", "مكرر"]
    assert cells(Contract(null_tokens=("", "NA")))[3] is None


def test_fingerprints(spark, tmp_path):
    for name, content in (("a", b"x\ny\n"), ("b", b"x\ny\n"), ("c", b"y\nx\n")):
        (tmp_path / f"{name}.csv").write_bytes(content)
    whole = {r["source_file"]: r["file_sha256"] for r in releases.file_fingerprints(spark, str(tmp_path)).collect()}
    assert whole["a.csv"] == whole["b.csv"] == hashlib.sha256(b"x\ny\n").hexdigest() != whole["c.csv"]
    tree = {r["source_file"]: r["file_sha256"] for r in releases.file_fingerprints(spark, str(tmp_path), 1).collect()}
    assert tree["a.csv"] == tree["b.csv"] != tree["c.csv"] and tree["a.csv"].startswith("tree-")


def test_fingerprints_of_large_files_see_line_ends(spark, tmp_path):
    contents = {"crlf": b"x\r\ny\r\n", "lf": b"x\ny\n", "open": b"x\ny", "same": b"x\ny\n"}
    for name, content in contents.items():
        (tmp_path / f"{name}.csv").write_bytes(content)
    for most in (1 << 20, 1):
        got = {r["source_file"][:-4]: r for r in releases.file_fingerprints(spark, str(tmp_path), most).collect()}
        assert len({r["file_sha256"] for r in got.values()}) == 3 and got["lf"]["file_sha256"] == got["same"]["file_sha256"]
        assert {n: r["n_bytes"] for n, r in got.items()} == {n: len(c) for n, c in contents.items()}


def test_tree_fingerprint_has_several_levels(spark):
    lines = spark.range(1, 101).selectExpr("'f' AS source_path", "id AS source_row_number", "cast(id AS string) AS value")
    one = releases.line_fingerprints(lines, fan_in=3).first()
    two = releases.line_fingerprints(lines.repartition(7), fan_in=3).first()
    assert one == two and one["n_bytes"] == sum(len(str(i)) + 1 for i in range(1, 101))
    other = releases.line_fingerprints(lines.where("id <> 50"), fan_in=3).first()
    assert other["file_sha256"] != one["file_sha256"]


def test_load_is_idempotent_per_quarter(spark, make_file, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    first = make_file(HEADERS, [ROW_A, HEADERS, ROW_A], "q1")
    second = make_file(HEADERS, [ROW_B], "q2")
    load_release(warehouse, first, "2026Q1")
    load_release(warehouse, second, "2026Q2")
    manifest = load_release(warehouse, first, "2026Q1").first()
    assert (manifest["rows_in_file"], manifest["rows_loaded"]) == (3, 3)
    assert manifest["validation"]["layout_counts"].asDict() == {"A": 2, "B": 0}
    bronze = read_bronze(warehouse)
    assert {r[0]: r[1] for r in bronze.groupBy("source_quarter").count().collect()} == {"2026Q1": 3, "2026Q2": 1}
    rows = bronze.where("source_quarter = '2026Q1'").orderBy("source_row_number").collect()
    assert [r["source_row_number"] for r in rows] == [3, 4, 5]
    assert rows[0]["issue_type_raw"] == ROW_A[0] and rows[0]["source_file"].startswith("q1.")
    with open(first, "rb") as handle:
        assert rows[0]["file_sha256"] == hashlib.sha256(handle.read()).hexdigest()
    assert dict(bronze.dtypes)["source_row_number"] == "bigint" and dict(bronze.dtypes)["ingested_at"] == "timestamp"
    stored = read_manifest(warehouse)
    assert stored.count() == 3 and stored.select(F.count_distinct("batch_id")).first()[0] == 3


def test_rejected_file_writes_nothing(spark, make_file, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    with pytest.raises(ReleaseRejected):
        load_release(warehouse, make_file(HEADERS[:5], [ROW_A[:5]]), "2026Q1")
    assert not (tmp_path / "wh").exists()


def test_contract_document(tmp_path):
    path = tmp_path / "c.json"
    path.write_text(
        '{"file": {"header_row": 2, "expected_column_count": 1}, "columns": {"issue_type_raw": {"aliases": ["i"], '
        '"required": true}}, "accepted_values": {"status_ar": ["d", "p"]}, "rules": {"unknown_status": "fail"}}'
    )
    contract = load_contract(str(path))
    assert (contract.header_row, contract.expected_columns, contract.column_names) == (2, 1, ["issue_type_raw"])
    assert contract.labels.completed == "d" and contract.rules["unknown_status"] == "fail"
    assert contract.rules["column_count_mismatch"] == "fail"
    path.write_text('{"layouts": {"A": {"default": true}, "B": {"detect_column": "c", "detect_pattern": "x"}}}')
    assert [(x.name, x.pattern, x.swapped) for x in load_contract(str(path)).layouts] == [("B", "x", True), ("A", "", False)]
    for wrong in ('{"rules": {"unknown_statuses": "fail"}}', '{"rules": {"unknown_status": "ignore"}}',
                  '{"rules": {"column_count_mismatch": "drop_and_log"}}', '{"layouts": {"A": {}}}'):
        path.write_text(wrong)
        with pytest.raises(ValueError):
            load_contract(str(path))


# ---------------------------------------------------------------- files that cannot be read in full
def report_by_name(spark, path):
    return {r["source_path"].rsplit("/", 1)[1]: r for r in validate_files(spark, path).collect()}


def test_files_that_cannot_be_read_in_full_fail(spark, tmp_path):
    files = {
        "title.csv": as_text([["t"]]),
        "empty.csv": b"",
        "wide.csv": as_text([["t"], HEADERS, [*ROW_A, "more"]]),
        "lines.csv": as_text([["t"], HEADERS, [ROW_A[0], "one\ntwo", *ROW_A[2:]]]),
        "broken.csv": as_text([["t"], HEADERS]) + f'{ROW_A[0]},"one\ntwo,{",".join(ROW_A[2:])}\n'.encode(),
        "partly.csv": as_text([["t"], HEADERS]) + f'{ROW_A[0]},5" one\ntwo 6",{",".join(ROW_A[2:])}\n'.encode(),
        "good.csv": as_text([["t"], HEADERS, ROW_A]),
        "quotes.csv": as_text([["t"], HEADERS, [ROW_A[0], 'say "hi", you', *ROW_A[2:]]]),
        "commas.csv": as_text([["t"], HEADERS]) + ",".join(ROW_A).encode() + b",,,\n",
        "header.csv": as_text([["t"], HEADERS]),
        "BOOK.XLSX": as_workbook([["t"], HEADERS, ROW_A]),
        "widebook.xlsx": as_workbook([["t"], HEADERS, [*ROW_A, "more"]]),
        "titlebook.xlsx": as_workbook([["t"]]),
    }
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    got = report_by_name(spark, str(tmp_path))
    assert set(got) == set(files)
    bad = {"title.csv", "empty.csv", "wide.csv", "broken.csv", "partly.csv", "widebook.xlsx", "titlebook.xlsx"}
    assert {n for n, r in got.items() if r["status"] == "fail"} == bad
    assert "header" in got["title.csv"]["errors"][0] and "7 columns" in got["wide.csv"]["errors"][0]
    assert "row 3 has no end" in got["broken.csv"]["errors"][0] and "part of its cell: row 3" in got["partly.csv"]["errors"][0]
    assert got["lines.csv"]["data_rows"] == 1
    assert got["BOOK.XLSX"]["data_rows"] == got["good.csv"]["data_rows"] == 1
    both = validate_files(spark, [str(tmp_path / "good.csv"), str(tmp_path / "BOOK.XLSX")])
    assert both.count() == 2


def test_short_file_is_not_loaded(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_bytes(as_text([["t"]]))
    with pytest.raises(ReleaseRejected):
        load_release(Warehouse(spark, str(tmp_path / "wh")), str(tmp_path / "in"), "2026Q1")


def test_files_of_one_name_and_empty_releases(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    for folder in ("x", "y"):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "r.csv").write_bytes(as_text([["t"], HEADERS, ROW_A, ROW_A]))
    manifest = load_release(warehouse, [str(tmp_path / "x"), str(tmp_path / "y")], "2026Q1")
    assert [(r["rows_in_file"], r["rows_loaded"]) for r in manifest.collect()] == [(2, 2), (2, 2)]
    (tmp_path / "z.csv").write_bytes(as_text([["t"], HEADERS]))
    load_release(warehouse, str(tmp_path / "x"), "2026Q2")
    load_release(warehouse, str(tmp_path / "z.csv"), "2026Q1")
    assert {r[0] for r in read_bronze(warehouse).select("source_quarter").distinct().collect()} == {"2026Q2"}


# ---------------------------------------------------------------- records over several lines
def random_release(seed, rows):
    rng = random.Random(seed)
    cells = ["a", "", "b\nc", 'say "hi"', '"\n"', "\n", "x,\ny", "\n\n\nz", "long " * 30]
    return [["t"], HEADERS, *[[rng.choice(cells) for _ in HEADERS] for _ in range(rows)]]


@pytest.mark.parametrize("split", [64, 300, 1 << 20])
def test_records_over_lines_and_splits(spark, tmp_path, split):
    files = {f"r{seed}.csv": random_release(seed, 60 + 40 * seed) for seed in range(4)}
    files["plain.csv"] = [["t"], HEADERS, *[ROW_A] * 50]
    for name, rows in files.items():
        (tmp_path / name).write_bytes(as_text(rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        release = releases.read_release(spark, str(tmp_path))
        got = collections.defaultdict(dict)
        for r in release.rows.collect():
            got[r.source_path.rsplit("/", 1)[1]][r.source_row_number] = [c or "" for c in r.cells]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for name, rows in files.items():
        assert got[name] == {i: r for i, r in enumerate(rows, 1) if i > 2}
    assert all(r.broken is None for r in release.shapes.collect())


def test_fine_splits_take_no_more_tasks(spark, tmp_path):
    """What tasks report to the driver grows with their number: a task reads many splits, and later steps read no splits at all."""
    rows = random_release(7, 400)
    (tmp_path / "r.csv").write_bytes(as_text(rows))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    context = spark.sparkContext
    try:
        context.setJobGroup("fine splits", "")
        release = releases.read_release(spark, str(tmp_path), split_bytes="256")
        got = {r.source_row_number: [c or "" for c in r.cells] for r in release.rows.collect()}
        tracker = context.statusTracker()
        stages = {s for job in tracker.getJobIdsForGroup("fine splits") for s in tracker.getJobInfo(job).stageIds}
        tasks = max(info.numTasks for info in map(tracker.getStageInfo, stages) if info)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    lines = records.tagged_lines(spark, str(tmp_path), F.lit(True), split_bytes="256")
    assert got == {i: r for i, r in enumerate(rows, 1) if i > 2}
    assert lines.select("_block").distinct().count() > 100 > 20 > tasks
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == size


def test_line_ends_of_windows_and_long_records(spark, tmp_path):
    text = as_text([["t"], HEADERS, [ROW_A[0], "one\ntwo", *ROW_A[2:]], ROW_A]).replace(b"\n", b"\r\n")
    (tmp_path / "w.csv").write_bytes(text)
    rows = releases.read_release(spark, str(tmp_path)).rows.collect()
    assert [(r.source_row_number, r.cells[1]) for r in sorted(rows, key=lambda r: r[1])] == [(3, "one\ntwo"), (4, ROW_A[1])]
    bounded = records.read_records(spark, str(tmp_path), F.lit(True), longest=20)
    assert "longer than 20" in bounded.broken.first().why


def test_plain_files_are_not_shuffled(spark, tmp_path):
    (tmp_path / "p.csv").write_bytes(as_text([["t"], HEADERS, *[ROW_A] * 5]))
    plan = releases.read_release(spark, str(tmp_path)).rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Window" not in plan


# ---------------------------------------------------------------- staged loads
def stored_rows(warehouse):
    return sorted((r.source_quarter, r.batch_id, r.source_row_number) for r in read_bronze(warehouse).collect())


@pytest.fixture
def loaded(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(as_text([["t"], HEADERS, ROW_A, ROW_B]))
    (tmp_path / "b.csv").write_bytes(as_text([["t"], HEADERS, ROW_A, ROW_A, ROW_A]))
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    load_release(warehouse, str(tmp_path / "a.csv"), "2026Q1", batch_id="one")
    return warehouse


def test_load_that_fails_leaves_the_quarter(loaded, tmp_path, monkeypatch):
    before = stored_rows(loaded)
    with pytest.raises(ZeroDivisionError):
        load_release(loaded, str(tmp_path / "b.csv"), "2026Q1", gate=lambda batch: 1 // 0, batch_id="two")
    lost = RowCounts.get
    monkeypatch.setattr(RowCounts, "get", lambda self: (lambda n, d: (n, {k: v - 1 for k, v in d.items()}))(*lost(self)))
    with pytest.raises(ReleaseRejected, match="did not arrive"):
        load_release(loaded, str(tmp_path / "b.csv"), "2026Q1", batch_id="three")
    monkeypatch.undo()
    with pytest.raises(ReleaseRejected, match="no quarter"):
        load_release(loaded, str(tmp_path / "b.csv"), F.lit(None).cast("string"))
    assert stored_rows(loaded) == before and read_manifest(loaded).count() == 1
    assert not [p.name for p in (tmp_path / "wh" / "bronze" / "requests").iterdir() if "two" in p.name or "three" in p.name]


def test_repeated_commit_is_one_entry(loaded, tmp_path):
    for _ in range(2):
        load_release(loaded, str(tmp_path / "b.csv"), "2026Q1", batch_id="two")
    table = bronze_table(loaded)
    assert [(e["number"], e["batch_id"], e["partitions"]) for e in table.entries()] == [(1, "one", {"2026Q1": 2}), (2, "two", {"2026Q1": 3})]
    assert stored_rows(loaded) == [("2026Q1", "two", n) for n in (3, 4, 5)]
    assert read_manifest(loaded).count() == 2
    assert table.commit("one", {"2026Q1": 99}, "later")["partitions"] == {"2026Q1": 2} and len(table.entries()) == 2
    assert table.discard_replaced("batch", loading.DROPPED) == ["one"] and len(stored_rows(loaded)) == 3


def test_load_reads_no_bronze_and_filters_prune_it(loaded, tmp_path, monkeypatch):
    monkeypatch.setattr(loading.CommittedTable, "read", lambda *a: pytest.fail("a load read the table"))
    load_release(loaded, str(tmp_path / "b.csv"), "2026Q2", batch_id="two")
    monkeypatch.undo()
    plan = read_bronze(loaded).where("source_quarter = '2026Q2'")
    assert plan.count() == 3
    filters = plan._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "batch#" in filters and "source_quarter#" in filters


def test_row_counts_are_exact_over_many_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(RowCounts, "KEYS", 16)
    rows = spark.range(0, 50_000, 1, 13).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id % 41 END AS key", "id")
    counts = RowCounts(41)
    counts.watch(rows, "key").write.parquet(str(tmp_path / "t"))
    total, per_key = counts.get()
    assert total == 50_000 and per_key == {r.key: r.n for r in rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).collect()}


RETRIED = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import SparkSession
from reqlytics.sources.warehouse import RowCounts
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").getOrCreate()
def flaky(batches):
    for i, batch in enumerate(batches):
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise OSError("lost")
rows = spark.range(0, 5000, 1, 4).selectExpr("id % 5 AS key").mapInArrow(flaky, "key long")
counts = RowCounts(5)
counts.watch(rows, "key").write.parquet(sys.argv[2])
print("counted", counts.get())
"""


def test_retried_tasks_count_once(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run([sys.executable, "-c", RETRIED, root, str(tmp_path / "out")], capture_output=True, text=True, timeout=180)
    assert f"counted {(5000, {k: 1000 for k in range(5)})}" in done.stdout, done.stderr[-2000:]


# ---------------------------------------------------------------- reactions
def reacting(reaction, **more):
    rules = {r: reaction for r in ("embedded_header_row", "unknown_layout_row", "unknown_status", "unknown_repeat_flag", "unknown_time_band")}
    layouts = (Layout("B", "closure_slot_raw", TIME_BAND_PATTERN, swapped=True), Layout("A", "closure_slot_raw", r"^\d+$"))
    return replace(Contract(), layouts=layouts, rules={**Contract().rules, **rules}, **more)


ODD = [ROW_A, HEADERS, [None] * 6, [*ROW_A[:3], "soon", *ROW_A[4:]], [*ROW_A[:2], "lost", *ROW_A[3:]], [*ROW_B[:3], "07:00 08:00", *ROW_B[4:]],
       [*ROW_A[:5], None], [f"  {HEADERS[0]} ", *ROW_A[1:]]]


def test_reactions(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(as_text([["t"], HEADERS, *ODD]))
    got = {r: validate_files(spark, str(tmp_path / "a.csv"), reacting(r)).first() for r in ("warn", "fail", "drop_and_log")}
    assert [got[r]["status"] for r in got] == ["pass_with_warnings", "fail", "pass"]
    assert (len(got["warn"]["warnings"]), len(got["fail"]["errors"]), got["drop_and_log"]["warnings"]) == (5, 5, [])
    assert {(r["unknown_layout_rows"], r["embedded_header_rows"], r["invalid_time_band"]) for r in got.values()} == {(1, 2, 1)}
    assert (got["warn"]["dropped_rows"], got["drop_and_log"]["dropped_rows"]) == (0, 6)
    assert got["warn"]["time_band_examples"] == ["07:00 08:00"]

    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    load_release(warehouse, str(tmp_path / "a.csv"), "2026Q1", reacting("drop_and_log"))
    dropped = sorted((r.source_row_number, r.rule, r.value) for r in read_dropped(warehouse).collect())
    assert [d[:2] for d in dropped] == [
        (4, "embedded_header_row"), (6, "unknown_layout_row"), (7, "unknown_status"), (8, "unknown_time_band"),
        (9, "unknown_repeat_flag"), (10, "embedded_header_row"),
    ]
    assert [d[2] for d in dropped[1:4]] == ["soon", "lost", "07:00 08:00"] and dropped[4][2] is None
    bronze = read_bronze(warehouse)
    assert bronze.count() == 8 and [r[0] for r in build_silver(bronze, reacting("drop_and_log")).select("source_row_number").collect()] == [3, 5]
    assert build_silver(bronze, reacting("warn")).count() == 8
    kept = {r.source_row_number: r.source_layout for r in build_silver(bronze, reacting("warn")).collect()}
    assert kept[3] == "A" and kept[6] is None and kept[8] == "B"
    with pytest.raises(ReleaseRejected):
        load_release(warehouse, str(tmp_path / "a.csv"), "2026Q1", reacting("fail"))
    load_release(warehouse, str(tmp_path / "a.csv"), "2026Q1", reacting("warn"))
    assert read_dropped(warehouse).count() == 0


def test_partitioned_writes_do_not_sort(spark, tmp_path):
    """A session with no setting of its own: a task must not hold all its rows to sort them by partition."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    own = spark.conf.get(name)
    rows = spark.range(0, 90, 1, 2).select("id", F.concat(F.lit("q"), F.col("id") % 9).alias("q"))
    expected = sorted((i, f"q{i % 9}") for i in range(90))
    spark.sql(f"CREATE TABLE kept (id long, q string) USING parquet PARTITIONED BY (q) LOCATION '{tmp_path}/kept'")
    try:
        spark.conf.unset(name)
        warehouse = Warehouse(spark, str(tmp_path / "a"))
        rows.createOrReplaceTempView("some_rows")
        assert "Sort" not in spark.sql("EXPLAIN INSERT INTO kept SELECT * FROM some_rows").first()[0]
        assert sorted(map(tuple, warehouse.write(rows, "gold", "t", ["q"]).collect())) == expected
        spark.conf.set(name, "3")  # fewer than there are partitions; a session's own value stays
        fewer = Warehouse(spark, str(tmp_path / "b"))
        assert spark.conf.get(name) == "3"
        assert sorted(map(tuple, fewer.write(rows, "gold", "t", ["q"]).collect())) == expected
    finally:
        spark.conf.set(name, own)
        spark.sql("DROP TABLE kept")
