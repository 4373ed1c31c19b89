"""Inputs of the status report, derived by Spark from the test tables.

``k`` mixes the keys of a line; states and gaps are spread by remainders of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.functions.dates import plus_hours
from ordertide.operators import latest, open_lines
from ordertide.plans.status.ladder import STAGES, SUB_CODES
from ordertide.sources import small_table

from .tables import table

AS_OF = "1998-06-01 12:00:00"
MARKETS = ("US", "DE", "FR", "MX", "BR", "CO", "UK", "US")
TERMS = ("100% PI", "30% PI 70% CI", "30% PI 20% CI 50% BL 60", "0% PI 100% BL BL 30", "0% PI 100% CI", None)
ROLES = ("CM", "SM", "IM", "owner_1", "owner_2")
OWNER_TEAMS = (("owner_1", "Payment"), ("owner_2", "QC"), ("owner_3", "Packaging"))


def choose(index, options):
    return F.element_at(F.array(*[F.lit(option) for option in options]), (index % len(options)).cast("int") + 1)


def later(day, amount):
    return plus_hours(day, amount * 24)


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole change log with its visible keys."""
    return with_visible_keys(table(spark, sf_dir, "lineitem"))


def with_visible_keys(log: DataFrame) -> DataFrame:
    k = F.col("l_orderkey") * 7 + F.col("l_linenumber") * 5 + F.col("l_partkey") * 3 + F.col("l_suppkey")
    return log.withColumns({
        "k": k, "ship": F.col("l_shipdate").cast("timestamp"),
        "document_number": F.concat(F.lit("PO"), F.col("l_orderkey").cast("string")),
        "line_id": F.col("l_linenumber").cast("string"),
        "item": F.concat(F.lit("IT"), F.col("l_partkey").cast("string")),
        "asin": F.concat(F.lit("AS"), (F.col("l_partkey") % 300).cast("string")),
        "marketplace": choose(k, MARKETS),
        "vendor_id": F.col("l_suppkey"),
        "shipment_number": F.concat_ws("-", F.concat(F.lit("S"), F.col("l_suppkey")), F.date_format("l_shipdate", "yyyyMM")),
    })


def po_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest state of every line, open or not. Visible keys are made afterwards, so that the log is moved without them."""
    log = table(spark, sf_dir, "lineitem")
    lines = with_visible_keys(latest(log, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"]))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    lines = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    k, ship = F.col("k"), F.col("ship")
    status = (
        F.when(F.col("o_orderkey").isNull() & (F.col("l_linenumber") == 1), None)
        .when((F.col("o_orderstatus") == "F") & (F.col("l_returnflag") == "R"), "Closed")
        .when(k % 11 == 0, "Pending Supervisor Approval").when(k % 11 == 1, "Rejected By Supervisor")
        .otherwise("Open")
    )
    units = F.col("l_quantity").cast("long")
    received = F.when(k % 4 == 1, F.floor(units / 2)).when(k % 4 == 2, units).otherwise(F.lit(0)).cast("long")
    return lines.select(
        "document_number", "line_id", "item", "asin", "marketplace", "l_orderkey", "l_linenumber", "k",
        F.concat(F.col("l_suppkey").cast("string"), F.lit(" Vendor")).alias("po_vendor"),
        F.when(k % 6 == 1, "import_ic_flow").when(k % 6 > 1, F.concat(F.lit("memo_"), (k % 6).cast("string"))).alias("memo"),
        choose(F.col("l_suppkey"), TERMS).alias("supplier_payment_terms"),
        choose(k, ("Pending Confirmation", "Rejected", "Confirmed", "Confirmed", "Confirmed")).alias("supplier_confirmation_status"),
        F.concat_ws("-", "document_number", "line_id").alias("id"), choose(k, ("Brand A", "Brand B", None)).alias("associated_brands"),
        choose(k, ("FOB", "EXW", "DDP")).alias("incoterms"), F.floor(received / 2).cast("long").alias("quantity_on_shipments"),
        F.when(k % 4 == 0, "Yes").otherwise("No").alias("sm_line_signoff"),
        status.alias("final_status"), units.alias("quantity"), received.alias("quantity_received"),
        F.col("l_extendedprice").alias("item_rate_eur"), F.col("o_orderdate").cast("timestamp").alias("date_created"),
        F.when(k % 7 != 0, later(ship, k % 20 - 5)).alias("first_prd"),
        F.when(k % 13 != 0, later(ship, k % 9)).alias("planned_prd"),
        F.when(k % 10 != 0, later(ship, k % 50 - 10)).alias("prd"),
        F.when(k % 6 != 0, later(ship, k % 15)).alias("accepted_prd"),
        choose(k, ("Auto-approved", "Approved by IM", "Requested", "Requested")).alias("prd_status"),
        F.when(k % 5 != 0, later(ship, k % 30)).alias("confirmed_crd"),
        F.when(k % 4 != 0, later(ship, k % 12)).alias("quality_control_date"),
        choose(k, ("1. Open", "3. Passed", "6. Waived", "x", "2. Planned")).alias("quality_control_status"),
        F.when(k % 3 == 0, "Yes").otherwise("No").alias("im_line_signoff"),
        choose(k, ("Cargo Picked(SM)", "Ready for batching", "Ready for batching", "In production", "Planned")).alias("production_status"),
        F.when(F.col("l_linenumber") < 6, F.concat(F.lit("B"), (F.col("l_orderkey") - F.col("l_orderkey") % 2).cast("string"))).alias("batch_id"),
        choose(k, ("AMZ", "3PL")).alias("wh_type"),
        F.when(k % 17 == 0, "Yes").otherwise("No").alias("considered_anti_po"),
        F.when(k % 3 == 0, "No").otherwise("Yes").alias("prd_reconfirmation"),
        F.when(k % 4 != 0, F.concat(F.lit("Bill #"), (k % 1000).cast("string"))).alias("invoice_number"),
        F.when(k % 3 == 0, "Bill:Paid In Full").otherwise("Bill:Open").alias("invoice_status"),
    )


def shipment_log(log: DataFrame) -> DataFrame:
    k, ship = F.col("k"), F.col("ship")
    return log.where(F.col("l_returnflag") != "N").select(
        "document_number", "item", "line_id", "shipment_number",
        F.struct("l_shipdate", "l_suppkey", "l_extendedprice", "l_quantity").alias("load_seq"),
        choose(k, ("To Be Shipped", "In Transit", "Received", "Partially Received", "Planned")).alias("shipment_status"),
        F.when(k % 3 == 0, "Delivered").otherwise("Open").alias("substatus"),
        choose(k, ("Ocean", "Air")).alias("shipment_method"),
        F.when(k % 3 != 1, later(ship, F.lit(3))).alias("shipment_pickup_date"),
        F.when((k % 4).isin(1, 2), later(ship, F.lit(5))).alias("shipment_shipping_date"),
        F.when(k % 5 != 0, later(ship, F.lit(38))).alias("expected_arrival_date"),
        F.when(k % 4 == 2, later(ship, F.lit(35))).alias("actual_arrival_date"),
        F.when(k % 8 == 2, later(ship, F.lit(45))).alias("actual_delivery_date"),
    )


def batch_rows(orders: DataFrame) -> DataFrame:
    even = orders.where(F.col("o_orderkey") % 2 == 0)
    return even.select(
        F.concat(F.lit("B"), F.col("o_orderkey").cast("string")).alias("batch_id"),
        F.floor(F.col("o_orderkey") / 2).cast("long").alias("b"), F.col("o_orderdate").cast("timestamp").alias("day"),
    )


def _tracker(rows: DataFrame, number, keys, every: int, name: str, out: str) -> DataFrame:
    """A hand-kept tracker: a remark for each key whose number is a multiple of ``every``."""
    text = F.when(number % 2 == 0, f"No {name} Blocker Mentioned").otherwise(f"{name} note")
    return rows.where(number % every == 0).groupBy(*keys).agg(F.min(text).alias(out))


def status_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every input of the status report."""
    log, orders = log_lines(spark, sf_dir), table(spark, sf_dir, "orders")
    part, supplier = table(spark, sf_dir, "part"), table(spark, sf_dir, "supplier")
    region = table(spark, sf_dir, "region")
    o, p, s = F.col("o_orderkey"), F.col("p_partkey"), F.col("s_suppkey")
    documents = orders.select(F.concat(F.lit("PO"), o.cast("string")).alias("document_number"), "o_orderkey")
    batch, b = batch_rows(orders), F.col("b")
    articles = log.select("document_number", "item", (F.col("l_orderkey") + F.col("l_partkey")).alias("n")).distinct()
    n = F.col("n")
    line_keys, num = ["document_number", "item", "line_id"], F.col("l_orderkey") + F.col("l_linenumber")
    ships = log.select("shipment_number", (F.col("l_suppkey") + F.month("l_shipdate")).alias("n")).distinct()
    asin = F.concat(F.lit("AS"), (p % 300).cast("string")).alias("asin")
    return {
        "lines": open_lines(po_lines(spark, sf_dir)),
        "supplier_confirmation": documents.where(o % 3 != 1),
        "pi_status": documents.where(o % 3 != 0).select(
            "document_number", choose(o, ("Paid In Full", "Pending Approval", "Open", "Open")).alias("ns_pi_status")),
        "static_payment": documents.where(o % 50 == 0).select("document_number", F.lit("Paid In Full").alias("ns_pi_status")),
        "pi_invoices": documents.where(o % 4 != 1).select(
            "document_number", choose(o, ("03. PI Upload Pending", "04a. SM Review Pending", "05a. Approved")).alias("vp_pi_status")),
        "payrun_documents": documents.where(o % 5 == 0).select(
            "document_number", choose(o, ("Pay", "On Hold", "Reject", "Yes")).alias("pi_payment_status")),
        "payrun_invoices": part.groupBy(F.concat(F.lit("Bill #"), (p % 1000).cast("string")).alias("invoice_number")).agg(
            F.min(choose(F.col("p_size"), ("Pay", "Pay", "Pay", "On Hold", "Reject"))).alias("line_payment_approval")),
        "prepayment": _tracker(documents, o, ["document_number"], 4, "PI", "l2_pi"),
        "shipments": shipment_log(log),
        "l2_compliance": _tracker(log, num, line_keys, 2, "Compliance", "l2_compliance"),
        "l2_prd": _tracker(log, num, line_keys, 3, "PRD", "l2_prd"),
        "l2_cprd": _tracker(log, num, line_keys, 4, "CPRD", "l2_cprd"),
        "l2_g2": _tracker(log, num, line_keys, 5, "G2", "l2_g2"),
        "l2_qc": _tracker(log, num, line_keys, 6, "QC", "l2_qc"),
        "transparency_requests": articles.where(n % 3 == 0).select(
            "document_number", "item", F.when(n % 2 == 0, "Yes").otherwise("No").alias("transparency_pending"), F.lit(2).alias("load_seq"),
        ).unionByName(articles.where(n % 6 == 3).select(
            "document_number", "item", F.lit("Yes").alias("transparency_pending"), F.lit(1).alias("load_seq"))),
        "packaging": articles.where(n % 4 != 0).select(
            "document_number", "item", F.when(n % 5 == 0, "Yes").otherwise("No").alias("packaging_pending"),
            choose(n, ("06a. EAN Pending", "06b. SCM Check Pending", "06d. Label Creation Pending")).alias("packaging_l2")),
        "transparency_master": part.where(p % 300 % 4 == 0).select(asin, F.lit("Yes").alias("transparency_check")).distinct(),
        "memo_map": region.select(
            F.concat(F.lit("memo_"), F.col("r_regionkey").cast("string")).alias("memo"), F.col("r_name").alias("placement_batch")),
        "vendor_map": supplier.select(
            s.alias("vendor_id"), F.concat(F.lit("owner_"), (s % 7).cast("string")).alias("cm"),
            F.concat(F.lit("owner_"), (s % 5).cast("string")).alias("sm"),
            F.when(F.col("s_nationkey") % 3 == 0, "China").otherwise("Other").alias("vendor_country"),
            choose(F.col("s_nationkey"), ("EU", "US", "CN")).alias("vendor_team")),
        "compliance": log.where(F.col("l_partkey") % 4 != 0).groupBy("item", "marketplace", "vendor_id").agg(
            F.min(choose(F.col("l_partkey") + F.col("l_suppkey"), ("Approved", "Approved", "Approved", "Blocked", "Pending"))).alias("compliance_status")),
        "master_data": part.select(
            F.concat(F.lit("IT"), p.cast("string")).alias("item"), F.lit("US").alias("marketplace"),
            choose(F.col("p_size"), ("No Blocker", "Reroute or Cancel", "Wait")).alias("md_blocker")),
        "priority_map": part.groupBy(asin).agg(F.min(F.col("p_size") % 2 + 1).alias("n")).select(
            "asin", F.lit("US").alias("marketplace"), F.concat(F.lit("Priority "), F.col("n").cast("string")).alias("priority")),
        "batches": batch.select(
            "batch_id",
            F.when(b % 5 == 0, "Not Booked").when(b % 5 != 1, "Booked").when(b % 3 != 0, "Booked").otherwise("Not Booked").alias("batch_booking"),
            choose(b, ("FOB", "EXW", "DDP", "DAP", "FCA")).alias("batch_incoterms"),
            choose(b, ("Truck late", None, "Documents late")).alias("spd_delay_reason"),
            F.when(b % 6 != 0, later("day", b % 120)).alias("spd"),
            F.when(b % 4 == 0, later("day", F.lit(60))).alias("actual_pickup_date"),
            F.when(b % 8 == 1, later("day", F.lit(70))).alias("gate_in_date"),
            F.when(b % 8 == 5, later("day", F.lit(80))).alias("actual_shipping_date")),
        "packing_lists": batch.where(b % 5 != 0).select("batch_id", choose(b, (
            "Signed-Off", "Signed-Off", "14a. Documents Missing", "14b. SM Sign-Off Missing", "14c. FFW Sign-Off Missing",
            "Signed-Off")).alias("batch_sign_off")),
        "fob": batch.where(b % 3 == 0).select("batch_id", choose(b, ("Released", "Waiting", None, "Waiting")).alias("fob_status"), F.when(b % 9 != 0, later("day", F.lit(75))).alias("fob_date")),
        "g4": _tracker(batch, b, ["batch_id"], 3, "G4", "l2_g4"),
        "spd_blockers": _tracker(batch, b, ["batch_id"], 4, "SPD", "l2_spd"),
        "ffw_status": _tracker(batch, b, ["batch_id"], 5, "FFW", "l2_pickup"),
        "ffw_blockers": batch.where(b % 7 == 0).select(
            "batch_id", choose(b, ("Yes", "No", "No truck")).alias("ffw_blocker")),
        "telex": ships.where(n % 2 == 0).select(
            "shipment_number", F.when(n % 3 == 0, F.to_timestamp(F.lit("1998-01-01"))).alias("telex_ffw_date"),
            F.when(n % 4 == 0, F.to_timestamp(F.lit("1998-01-02"))).alias("telex_supplier_date")),
        "telex_supplier": ships.where(n % 5 != 0).select(
            "shipment_number", F.when(n % 5 == 1, "Released").otherwise("Not Released").alias("supplier_sheet"),
            F.when(n % 2 == 0, "No Telex Blocker Mentioned").otherwise("Supplier note").alias("telex_remark")),
        "telex_ffw": ships.where(n % 7 != 0).select(
            "shipment_number", F.when(n % 7 == 1, "Released").otherwise("Not Released").alias("ffw_sheet"),
            F.when(n % 2 == 0, "No FFW Telex Blocker Mentioned").otherwise("FFW note").alias("telex_remark")),
        **status_maps(spark),
    }


def status_rows() -> list[tuple]:
    """(code, sub status, accountable, responsible) for every text a line can show."""
    texts = [(code, f"{code}. Sub stage {code}") for code in SUB_CODES]
    texts += [(None, STAGES[code]) for code in ("A", "B", "C", "03", "08", "12", "15", "18")]
    texts += [(None, text) for text in ("04a. SM Review Pending", "14a. Documents Missing", "14b. SM Sign-Off Missing",
                                        "14c. FFW Sign-Off Missing", "06a. EAN Pending", "06b. SCM Check Pending")]
    return [(code, text, ROLES[(at + 1) % 5], ROLES[at % 5]) for at, (code, text) in enumerate(texts)]


def blocker_rows() -> list[tuple]:
    """(bucket, owner of the first listing, owner of the last listing)."""
    names = [f"No {x} Blocker Mentioned" for x in ("Compliance", "PI", "PRD", "G2", "QC", "SPD", "FFW", "Telex")]
    names += ["No truck", "Compliance note", "PI note", "FFW note", "Supplier note", "Cargo Picked(SM)"]
    return [(name, ("owner_1", "SM", "CM", "owner_2")[at % 4], ("owner_3", "IM")[at % 2]) for at, name in enumerate(names)]


def status_maps(spark: SparkSession) -> dict[str, DataFrame]:
    """The small hand-kept maps (a few dozen configured rows)."""
    return {
        "status_map": small_table(spark, status_rows(), "code string, sub_status string, accountable string, responsible string"),
        "blockers_map": small_table(spark, blocker_rows(), "bucket string, owner_first string, owner_last string"),
        "reporting_map": small_table(
            spark, [(name, f"R{code}") for code, name in STAGES.items()], "status string, reporting_status string"),
        "owner_teams": small_table(spark, OWNER_TEAMS, "owner string, team string"),
    }
