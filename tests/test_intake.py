"""Contracts, tracker tabs and raw pulls on small tables, and what their plans read."""

import re
import tempfile
from datetime import date, datetime

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from checks.compare import compare, connect
from checks.intake_oracle import ORACLE
from checks.intake_queries import QUERIES
from checks.raw_tables import raw_sources, raw_tabs
from ordertide.plans.intake import CONTRACTS, TRACKERS, Contract, admitted, drift, pulls, read_text, read_trackers, report_trackers, tracker_rows

QUICK = [name for name in QUERIES if name not in ("report_from_raw",)]


@pytest.mark.parametrize("name", [*QUICK, "report_from_raw"])
def test_query_matches_sql(spark, sf, name):
    state, detail = compare(spark, connect(sf), sf, QUERIES[name], ORACLE[name])
    assert state == "ok", detail


def test_raw_tables_keep_their_contracts(spark, sf):
    raw = raw_sources(spark, sf)
    assert set(raw) | {"stage_tracker"} == set(CONTRACTS)
    assert {name: drift(df, CONTRACTS[name]) for name, df in raw.items() if drift(df, CONTRACTS[name])} == {}


def test_drifted_tables_are_refused_before_they_are_read(spark):
    wanted = {"t": Contract("a string, b bigint", ("a",))}
    good = spark.createDataFrame([("x", 1, True)], "a string, b bigint, more boolean")
    assert admitted("t", good, wanted).columns == ["a", "b"]
    assert drift(spark.createDataFrame([("x", "1")], "a string, b string"), wanted["t"]) == [("b", "bigint", "string")]
    with pytest.raises(ValueError, match="t has drifted: a is missing, not string"):
        admitted("t", good.drop("a"), wanted)


def test_lines_that_do_not_fit_are_set_apart(spark, tmp_path):
    contract = Contract("id string, n bigint, day date", ("id",))
    (tmp_path / "a.csv").write_text('id,n,day\nx,1,2024-01-02\ny,one,2024-01-02\nz,3\n,4,2024-01-02\n"q,""r""",5,\n')
    good, broken = read_text(spark, str(tmp_path / "a.csv"), contract)
    assert rows(good.select("id")) == [('q,"r"',), ("x",)]  # a pruned column is checked all the same
    assert {(r["reason"], r["line"][:1]) for r in broken.collect()} == {("broken line", "y"), ("broken line", "z"), ("no key", "{")}
    (tmp_path / "b.json").write_text('{"id": "x", "n": 1}\n{"id": "y", "n": "one"}\nnot json\n{"n": 4}\n')
    good, broken = read_text(spark, str(tmp_path / "b.json"), contract, "json")
    assert rows(good.select("id", "n")) == [("x", 1)]
    assert sorted(r["reason"] for r in broken.collect()) == ["broken line", "broken line", "no key"]


def test_only_the_partition_of_the_day_is_read(spark, sf, tmp_path):
    tabs = raw_tabs(spark, sf)
    for name in ("l2_cprd", "telex_ffw"):
        tab = tabs[name]
        writer = tab.write.partitionBy("tab_date") if "tab_date" in tab.columns else tab.write
        writer.parquet(str(tmp_path / name))
    found = read_trackers(spark, str(tmp_path), "1998-06-01 08:00:00", ["l2_cprd", "telex_ffw"])
    text = plan(found["l2_cprd"])
    assert re.search(r"PartitionFilters: \[[^\]]*1998-06-01", text) and "SM Comments" not in text.split("ReadSchema")[1]
    assert found["l2_cprd"].where("l2_cprd = 'of yesterday'").isEmpty() and not found["l2_cprd"].isEmpty()
    with pytest.raises(ValueError, match="needs a day"):
        tracker_rows(tabs["l2_cprd"], TRACKERS["l2_cprd"])


def test_tabs_with_their_names_in_the_first_row(spark):
    day = date(2024, 1, 2)
    tab = spark.createDataFrame(
        [("otif_id", "SM: PRD STATUS", " SM Comments", 0, day), ("L1", "x", "late", 1, day), (" ", "x", "late", 2, day), ("L2", "x", None, 3, day),
         ("otif_id", "other", "names", 0, date(2024, 1, 1)), ("L9", "x", "old", 1, date(2024, 1, 1))],
        "a string, b string, c string, load_seq long, tab_date date")
    found = tracker_rows(tab, TRACKERS["l2_prd"], "2024-01-02")
    assert rows(found) == [("L1", "late", 1), ("L2", "No PRD Blocker Mentioned", 3)]


def test_a_tab_without_a_column_is_refused(spark):
    with pytest.raises(ValueError, match="missing required columns"):
        tracker_rows(spark.createDataFrame([("a",)], "`PO RAZIN ID` string"), TRACKERS["l2_qc"])


def test_the_pay_run_serves_invoices_and_documents(spark):
    tab = spark.createDataFrame(
        [("7", "PO1", " Pay", 2), ("7", "PO2", "Reject", 1), ("8", None, "On Hold", 3), ("", "PO3", "Pay", 4)],
        "`Invoice No.` string, `PO No.` string, Final_Verdict string, load_seq int")
    payrun = {"payrun": tracker_rows(tab, TRACKERS["payrun"])}
    found = report_trackers(payrun)
    assert rows(found["payrun_invoices"]) == [("Bill #7", "Reject"), ("Bill #8", "On Hold")]
    assert rows(found["payrun_documents"]) == [("PO1", "Pay"), ("PO2", "Reject")]


def test_of_tied_snapshots_the_open_row_counts(spark):
    log = spark.createDataFrame(
        [("PO1", "1", 1, "a", "Closed", 5, 0, None), ("PO1", "1", 2, "c", "Closed", 5, 0, None), ("PO1", "1", 2, "b", "Open", 5, 0, None),
         ("PO1", "2", 1, "a", "Open", 5, 0, None), ("PO1", "2", 2, "a", "Closed", 5, 0, None), ("PO2", "1", 1, "a", None, 5, 0, None),
         ("PO3", "1", 1, "a", "Open", 5, 5, None), ("PO4", "1", 1, "a", "Open", 5, 1, "import_ic_flow"), ("PO5", "1", None, "a", "Open", 5, 1, "x")],
        "document_number string, line_id string, snapshot_datetime int, id string, final_status string, quantity int, quantity_received int, memo string")
    log = log.withColumns({"date_created": F.lit("01.02.2024 10:30"), "first_prd": F.lit("03.02.2024"), "accepted_prd": F.lit("soon")})
    found = pulls.po_lines(log)
    assert rows(found.select("document_number", "line_id", "id")) == [("PO1", "1", "b"), ("PO5", "1", "a")]
    assert found.select("date_created", "first_prd", "accepted_prd").first() == (datetime(2024, 2, 1, 10, 30), datetime(2024, 2, 3), None)


def _scans(text):
    return re.findall(r"FileScan parquet[^\n]*?InMemoryFileIndex\([^)]*\)\[([^\]]*)\]", text)


def test_star_reads_every_source_once_and_only_what_it_needs(spark, sf):
    folder = tempfile.mkdtemp(prefix="t-")  # plans cut long paths
    names = ("shipment_headers", "shipment_lines", "shipment_notes", "invoice_lines", "purchase_order_log", "packing_list_log")
    raw = raw_sources(spark, sf)
    stored = {}
    for name in names:
        raw[name].limit(50).write.parquet(f"{folder}/{name}")
        stored[name] = spark.read.parquet(f"{folder}/{name}")
    star = plan(pulls.shipment_lines_star(stored).where("shipment_number = 'S1-199601'"))
    reads = [next(n for n in names if f"/{n}" in path) for path in _scans(star)]
    assert sorted(set(reads)) == sorted(names)
    assert {n: reads.count(n) for n in names if n != "invoice_lines"} == {n: 1 for n in names if n != "invoice_lines"}
    # The filter on the shipment reaches headers, lines and the log of changed fields.
    for name in ("shipment_headers", "shipment_lines", "shipment_notes"):
        scan = next(line for line in star.splitlines() if f"/{name}]" in line)
        assert "S1-199601" in scan, name
    telex = plan(pulls.telex(stored))
    assert "shipment_notes" not in telex and "invoice_lines" not in telex
    assert "quantity_expected" not in telex and "supplier_payment_terms" not in telex
    batches = plan(pulls.batches(raw["batch_lines"], stored["purchase_order_log"]))
    assert "item_rate_eur" not in batches
