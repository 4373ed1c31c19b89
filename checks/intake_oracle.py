"""SQL for the way from raw tables and tracker tabs to the reports, written from the rules."""

from __future__ import annotations

from .status_oracle import groups, stage

MARKETS = "['US','DE','FR','MX','BR','CO','UK','US']"


def _doc(number: str) -> str:
    return f"'PO' || lpad(CAST({number} AS VARCHAR), 6, '0')"


def _batch(number: str) -> str:
    return f"'B' || lpad(CAST({number} - {number} % 2 AS VARCHAR), 11, '0')"


def _days(column: str, n: str) -> str:
    return f"CAST({column} AS TIMESTAMP) + to_days(CAST({n} AS INTEGER))"


_OPEN = """final_status NOT IN ('Closed', 'Legacy Closed', 'Fully Billed')"""
_TRACKED = _OPEN + " AND quantity - quantity_received > 0 AND (memo IS NULL OR memo <> 'import_ic_flow')"

#: Common tables by name, in an order in which each only reads those before it.
PIECES = {
    "lg": f"""SELECT *, l_orderkey * 7 + l_linenumber * 5 + l_partkey * 3 + l_suppkey AS k, {_doc('l_orderkey')} AS document_number,
        CAST(l_linenumber AS VARCHAR) AS line_id, 'IT' || l_partkey AS item, 'AS' || (l_partkey % 300) AS asin,
        ({MARKETS})[(l_orderkey * 7 + l_linenumber * 5 + l_partkey * 3 + l_suppkey) % 8 + 1] AS marketplace,
        {_doc('l_orderkey')} || '_' || l_linenumber AS po_line_key, 'S' || l_suppkey || '-' || strftime(l_shipdate, '%Y%m') AS shipment_number
      FROM lineitem""",
    "pol": f"""SELECT document_number, line_id, item, asin, marketplace, po_line_key, k, l_suppkey, l_partkey || '-' || l_suppkey AS id,
        CAST(o_orderdate AS TIMESTAMP) AS date_created, l_suppkey || ' Vendor' AS po_vendor,
        CASE WHEN k % 6 = 1 THEN 'import_ic_flow' WHEN k % 6 > 1 THEN 'memo_' || (k % 6) END AS memo,
        (['30% PI 0d 20% CI 0d 50% BL 60d', '100% PI 0d 0% CI 0d 0% BL 0d', '0% PI 0d 0% CI 0d 100% BL 45d', NULL])[l_suppkey % 4 + 1] AS supplier_payment_terms,
        (['Pending Confirmation','Rejected','Confirmed','Confirmed','Confirmed'])[k % 5 + 1] AS supplier_confirmation_status,
        CASE WHEN o_orderkey IS NULL AND l_linenumber = 1 THEN NULL WHEN o_orderstatus = 'F' AND l_returnflag = 'R' THEN 'Closed'
          WHEN k % 11 = 0 THEN 'Pending Supervisor Approval' WHEN k % 11 = 1 THEN 'Rejected By Supervisor' ELSE 'Open' END AS final_status,
        CAST(l_quantity AS BIGINT) AS quantity,
        CASE k % 4 WHEN 1 THEN CAST(l_quantity AS BIGINT) // 2 WHEN 2 THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS quantity_received,
        CAST(l_extendedprice AS DOUBLE) AS item_rate_eur,
        CASE WHEN k % 7 <> 0 THEN {_days('l_shipdate', 'k % 20 - 5')} END AS first_prd,
        CASE WHEN k % 13 <> 0 THEN {_days('l_shipdate', 'k % 9')} END AS planned_prd,
        CASE WHEN k % 10 <> 0 THEN {_days('l_shipdate', 'k % 50 - 10')} END AS prd,
        CASE WHEN k % 6 <> 0 THEN {_days('l_shipdate', 'k % 15')} END AS accepted_prd,
        (['Auto-approved','Approved by IM','Requested','Requested'])[k % 4 + 1] AS prd_status,
        CASE WHEN k % 5 <> 0 THEN {_days('l_shipdate', 'k % 30')} END AS confirmed_crd,
        CASE WHEN k % 4 <> 0 THEN {_days('l_shipdate', 'k % 12')} END AS quality_control_date,
        (['1. Open','3. Passed','6. Waived','x','2. Planned'])[k % 5 + 1] AS quality_control_status,
        CASE WHEN k % 3 = 0 THEN 'Yes' ELSE 'No' END AS im_line_signoff,
        (['Cargo Picked(SM)','Ready for batching','Ready for batching','In production','Planned'])[k % 5 + 1] AS production_status,
        CASE WHEN l_linenumber < 6 THEN {_batch('l_orderkey')} END AS batch_id, CASE WHEN k % 2 = 0 THEN 'AMZ' ELSE '3PL' END AS wh_type,
        CASE WHEN k % 17 = 0 THEN 'Yes' ELSE 'No' END AS considered_anti_po, CASE WHEN k % 3 = 0 THEN 'No' ELSE 'Yes' END AS prd_reconfirmation,
        CASE WHEN k % 4 <> 0 THEN 'Bill #' || (k % 1000) END AS invoice_number,
        CASE WHEN k % 3 = 0 THEN 'Bill:Paid In Full' ELSE 'Bill:Open' END AS invoice_status,
        CAST(l_shipdate AS TIMESTAMP) AS snapshot_datetime
      FROM lg LEFT JOIN orders ON l_orderkey = o_orderkey""",
    "newest": "SELECT * FROM pol QUALIFY dense_rank() OVER (PARTITION BY document_number, line_id ORDER BY snapshot_datetime DESC) = 1",
    "po_lines": f"""SELECT * FROM newest WHERE {_TRACKED}
      QUALIFY row_number() OVER (PARTITION BY document_number, line_id ORDER BY id) = 1""",
    "two": "SELECT *, o_orderkey AS o, CAST(o_orderdate AS TIMESTAMP) AS day, unnest([0, 1]) AS j FROM orders",
    "uploaded": f"""SELECT CASE WHEN o % 11 = 0 THEN 'B1#' || o WHEN o % 7 = 0 THEN {_batch('o')} ELSE {_batch('o')} || '#PL' || j END AS code,
        (['accepted-ffw','accepted-sm','uploaded','ocr1-accepted','rejected-ffw','draft'])[(o + j) % 6 + 1] AS pl_status,
        {_days('day', 'j')} AS created, {_days('day', 'o % 5')} AS seen, (['uploaded', NULL, 'pending'])[o % 3 + 1] AS telex_status FROM two""",
    "packing_lists": """SELECT split_part(code, '#', 1) AS batch_id, CASE pl_status WHEN 'accepted-ffw' THEN 'Signed-Off'
          WHEN 'accepted-sm' THEN '14c. FFW Sign-Off Missing' WHEN 'rejected-ffw' THEN '14a. Documents Missing' ELSE '14b. SM Sign-Off Missing' END AS batch_sign_off
      FROM uploaded WHERE pl_status <> 'draft' AND length(split_part(code, '#', 1)) = 12
      QUALIFY row_number() OVER (PARTITION BY split_part(code, '#', 1) ORDER BY created DESC, seen DESC, pl_status DESC) = 1""",
    "batch_lines": f"""SELECT {_batch('o')} AS batch_id, (['Cancelled', '', NULL, 'Confirmed'])[(o + j) % 4 + 1] AS vp_booking_status,
        (['FFW', NULL, ''])[o % 3 + 1] AS freight_forwarder, {_doc('o')} AS po_number, (['FOB','EXW','DDP','DAP','FCA'])[(o + j) % 5 + 1] AS incoterms,
        CASE WHEN o % 6 <> 0 THEN {_days('day', '(o + j) % 120')} END AS scr_date, (['Truck late', NULL, 'Documents late'])[o % 3 + 1] AS scrd_delay_reasons,
        {_days('day', 'j')} AS expected_pickup_date, CASE WHEN o % 8 < 2 THEN {_days('day', '60 + j')} END AS actual_pickup_date,
        CASE WHEN o % 16 > 13 THEN {_days('day', '70')} END AS gate_in_date, CASE WHEN o % 16 = 5 THEN {_days('day', '80')} END AS actual_shipping_date FROM two""",
    "batches": f"""SELECT *, CASE WHEN vp_booking_status = 'Cancelled' THEN 'Not Booked'
          WHEN trim(vp_booking_status) <> '' OR trim(freight_forwarder) <> '' THEN 'Booked' ELSE 'Not Booked' END AS batch_booking
      FROM (SELECT batch_id, max(vp_booking_status) AS vp_booking_status, max(freight_forwarder) AS freight_forwarder, max(po_number) AS po_number,
          max(incoterms) AS incoterms, max(scr_date) AS scr_date, max(scrd_delay_reasons) AS scrd_delay_reasons, CAST(NULL AS TIMESTAMP) AS ccrd_by_freight,
          max(expected_pickup_date) AS expected_pickup_date, max(actual_pickup_date) AS actual_pickup_date, max(gate_in_date) AS gate_in_date,
          CAST(NULL AS TIMESTAMP) AS expected_shipping_date, max(actual_shipping_date) AS actual_shipping_date
        FROM batch_lines WHERE batch_id IN (SELECT batch_id FROM (SELECT * FROM pol WHERE batch_id IS NOT NULL
          QUALIFY dense_rank() OVER (PARTITION BY batch_id, line_id ORDER BY snapshot_datetime DESC) = 1) WHERE {_OPEN}) GROUP BY batch_id)""",
    "ships": """SELECT DISTINCT shipment_number, l_suppkey + month(l_shipdate) AS n, CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS day FROM lg""",
    "headers": f"""SELECT *, (['To Be Shipped','In Transit','Received','Partially Received','Planned'])[n % 5 + 1] AS status,
        CASE WHEN n % 3 = 0 THEN 'Delivered' ELSE 'Open' END AS substatus, CASE WHEN n % 2 = 0 THEN 'Ocean' ELSE 'Air' END AS shipment_method,
        CASE WHEN n % 3 <> 1 THEN {_days('day', '3')} END AS picked, CASE WHEN n % 4 IN (1, 2) THEN {_days('day', '5')} END AS shipped,
        CASE WHEN n % 5 <> 0 THEN {_days('day', '38')} END AS expected_arrival_date, CASE WHEN n % 4 = 2 THEN {_days('day', '35')} END AS actual_arrival_date,
        CASE WHEN n % 8 = 2 THEN {_days('day', '45')} END AS actual_delivery_date, CASE WHEN n % 3 = 0 THEN {_days('day', '40')} END AS telex_release_date,
        CASE WHEN n % 3 = 2 THEN 3.5 ELSE n / 4 END AS gross_volume_cbm FROM ships""",
    "ship_lines": """SELECT shipment_number, document_number AS po, item, line_id AS own_line, k, po_line_key, CAST(l_quantity AS BIGINT) AS quantity_expected,
        CAST(l_shipdate AS TIMESTAMP) AS line_snapshot_date, l_suppkey FROM lg WHERE l_returnflag <> 'N'""",
    "shipments": """SELECT shipment_number, po, o.line_id, CASE WHEN k % 9 <> 0 THEN own_line END AS shipped_line_id, item, status, substatus, shipment_method,
        quantity_expected, quantity_expected - quantity_expected // 3 AS quantity_remaining, picked, shipped, expected_arrival_date, actual_arrival_date,
        actual_delivery_date, line_snapshot_date, day AS header_snapshot_date
      FROM ship_lines JOIN headers USING (shipment_number)
      JOIN (SELECT DISTINCT po_line_key, line_id FROM newest WHERE quantity - quantity_received > 0) o USING (po_line_key)""",
    "notes": f"""SELECT shipment_number, min(CASE WHEN j IN (0, 2) AND new_value IN ('partiallyReceived', 'received') AND old_value = 'inTransit' THEN moment END) AS actual_inbound_date,
        min(CASE WHEN j = 1 AND new_value IS NOT NULL AND old_value IS NULL THEN moment END) AS booking_confirmation_date
      FROM (SELECT shipment_number, j, {_days('day', '30 - j * 3 + n % 7')} AS moment,
          CASE WHEN j = 1 THEN CASE WHEN n % 4 = 0 THEN 'X0' END ELSE (['inTransit', 'planned'])[(n + j) % 2 + 1] END AS old_value,
          CASE WHEN j = 1 THEN CASE WHEN n % 5 <> 0 THEN 'X1' END ELSE (['received', 'partiallyReceived', 'lost'])[n % 3 + 1] END AS new_value
        FROM (SELECT *, unnest([0, 1, 2, 3]) AS j FROM ships)) GROUP BY shipment_number""",
    "terms": """SELECT po_line_key, asin, batch_id, item_rate_eur AS amount, ([30, 100, 0, NULL])[l_suppkey % 4 + 1] AS pi_value,
        ([20, 0, 0, 0])[l_suppkey % 4 + 1] AS ci_value, ([50, 0, 100, 0])[l_suppkey % 4 + 1] AS bl_value, ([60, 0, 45, 0])[l_suppkey % 4 + 1] AS bl_days
      FROM pol QUALIFY row_number() OVER (PARTITION BY po_line_key ORDER BY snapshot_datetime DESC, id DESC) = 1""",
    "invoices": """SELECT po_line_key, string_agg('INV' || (k % 1000), ', ' ORDER BY 'INV' || (k % 1000)) AS invoice_numbers,
        string_agg(CASE WHEN k % 3 = 0 THEN 'Paid In Full' ELSE 'Open' END, ', ' ORDER BY CASE WHEN k % 3 = 0 THEN 'Paid In Full' ELSE 'Open' END) AS invoice_statuses,
        sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS invoice_amount, sum(CAST(l_quantity AS DECIMAL(18,2))) AS invoice_quantity
      FROM lg WHERE k % 4 <> 0 GROUP BY po_line_key""",
    "batch_telex": "SELECT split_part(code, '#', 1) AS batch_id, max(created) AS batch_telex_date FROM uploaded WHERE telex_status = 'uploaded' GROUP BY 1",
    "star": """SELECT shipment_number, po_line_key, quantity_expected, gross_volume_cbm, telex_release_date, day AS gate_in, actual_inbound_date,
        booking_confirmation_date, asin, pi_value, ci_value, bl_value, bl_days, amount, invoice_numbers, invoice_statuses, invoice_amount, invoice_quantity,
        batch_telex_date
      FROM ship_lines JOIN headers USING (shipment_number) LEFT JOIN notes USING (shipment_number) LEFT JOIN terms USING (po_line_key)
      LEFT JOIN invoices USING (po_line_key) LEFT JOIN batch_telex USING (batch_id)""",
    "telex": """SELECT shipment_number, max(batch_telex_date) AS telex_supplier_date, max(telex_release_date) AS telex_ffw_date FROM star GROUP BY shipment_number""",
    "pi_invoices": f"""SELECT CASE WHEN contains(vendor_po, '#') THEN substr(split_part(vendor_po, '#', 2), 1, 8) END AS document_number, vendor_po, kind, moment, invoice_status,
        CASE WHEN invoice_status IN ('ocr1-accepted', 'uploaded') THEN '04a. SM Review Pending' WHEN invoice_status = 'pending-ns' THEN '04b. Accounting Approval Pending'
          WHEN invoice_status = 'open-ns' THEN '05b. Pending Approval' WHEN invoice_status = 'paid' THEN '05a. Approved' ELSE '03. PI Upload Pending' END AS vp_pi_status
      FROM (SELECT CASE WHEN o % 19 = 0 THEN 'no order' ELSE 'V' || o_custkey || '#' || {_doc('o')} || '-x' END AS vendor_po, CASE WHEN j = 1 THEN 'CI' ELSE 'PI' END AS kind,
          CASE WHEN j = 1 THEN 'CI' ELSE 'PI' END || '#' || (o + j) AS type_id, {_days('day', '(o * 3 + j * 2) % 5')} AS moment,
          (['rejected','ocr1-accepted','uploaded',NULL,'pending-ns','paid','open-ns','strange'])[(o + j) % 8 + 1] AS invoice_status
        FROM (SELECT *, o_orderkey AS o, CAST(o_orderdate AS TIMESTAMP) AS day, unnest([0, 1, 2]) AS j FROM orders))
      QUALIFY row_number() OVER (PARTITION BY vendor_po, kind ORDER BY moment DESC, type_id DESC) = 1""",
    "pi_status": f"""SELECT po AS document_number, status AS ns_pi_status FROM (
        SELECT DISTINCT right(source_po, 8) AS po, status FROM (
          SELECT 'BILL' || o || CASE WHEN o % 13 = 0 THEN '-cancelled' ELSE '' END AS bill, (['Paid In Full', ' pending approval', 'Open', 'Other'])[(o + j) % 4 + 1] AS status,
            {_days('day', 'j * (o % 3)')} AS moment, CASE WHEN o % 9 <> 0 THEN 'Purchase Order #' || {_doc('(o - o % 3)')} END AS source_po FROM two
          QUALIFY dense_rank() OVER (PARTITION BY bill ORDER BY moment DESC) = 1)
        WHERE source_po IS NOT NULL AND bill NOT LIKE '%cancelled%')
      WHERE po IN (SELECT document_number FROM (SELECT * FROM pol QUALIFY dense_rank() OVER (PARTITION BY document_number ORDER BY snapshot_datetime DESC) = 1) WHERE {_OPEN})
      QUALIFY row_number() OVER (PARTITION BY po ORDER BY CASE lower(trim(status)) WHEN 'paid in full' THEN 1 WHEN 'pending approval' THEN 2 WHEN 'open' THEN 3 ELSE 4 END, status) = 1""",
    "supplier_confirmation": f"""SELECT {_doc('o')} AS document_number, {_days('day', '(o + j) % 4')} AS moment, CASE WHEN (o + j) % 2 = 0 THEN 'confirmed' ELSE 'open' END AS po_status
      FROM two WHERE o % 17 <> 0 QUALIFY row_number() OVER (PARTITION BY o ORDER BY moment, po_status) = 1""",
    "master_data": f"""SELECT item, marketplace, operating_status, block_reason_code, CASE impact WHEN 'None' THEN 'No Blocker'
          WHEN 'Reroute to non-Blocked Geo or Cancel PO' THEN 'Reroute or Cancel' ELSE impact END AS md_blocker
      FROM (SELECT 'IT' || p AS item, ({MARKETS})[(p + j % 2) % 8 + 1] AS marketplace, TIMESTAMP '1998-01-01' + to_days(CAST((p * 5 + j * 7) % 90 AS INTEGER)) AS moment,
          CASE WHEN p % 2 = 0 THEN 'Active' ELSE 'Stopped' END AS operating_status, (['R1', ' ', NULL, 'R2'])[(p + j) % 4 + 1] AS block_reason_code,
          (['None', 'Reroute to non-Blocked Geo or Cancel PO', 'Wait', NULL, 'None'])[(p + j) % 5 + 1] AS impact
        FROM (SELECT p_partkey AS p, unnest([0, 1, 2]) AS j FROM part))
      WHERE trim(block_reason_code) <> '' AND (item, marketplace) IN (SELECT (item, marketplace) FROM pol WHERE quantity - quantity_received > 0)
      QUALIFY row_number() OVER (PARTITION BY item, marketplace ORDER BY moment DESC, block_reason_code DESC) = 1""",
    "compliance": """SELECT item, marketplace, vendor_id, (['Approved','Approved','Approved','Blocked','Pending'])[k % 5 + 1] AS compliance_status,
        CASE WHEN k % 2 = 0 THEN 'passed' ELSE 'failed' END AS deal_stage,
        item || CASE WHEN marketplace IN ('FR', 'BE', 'ES', 'PL', 'NL', 'SE', 'IT', 'DE') THEN 'Pan-EU' ELSE marketplace END AS article_market
      FROM (SELECT *, CASE WHEN l_partkey % 50 <> 1 THEN l_suppkey END AS vendor_id FROM lg WHERE l_partkey % 4 <> 0)
      QUALIFY row_number() OVER (PARTITION BY item, marketplace, vendor_id ORDER BY CAST(k AS VARCHAR)) = 1""",
    "stage_dates": f"""SELECT document_number || item || line_id AS po_id, {_days('day', '-90')} AS po_created_date,
        CASE WHEN l_linenumber <> 2 THEN {_days('day', '-60')} END AS po_approval_date
      FROM (SELECT document_number, line_id, l_linenumber, min(item) AS item, min(l_shipdate) AS day FROM lg GROUP BY ALL)
      WHERE (document_number, line_id) IN (SELECT (document_number, line_id) FROM newest WHERE {_TRACKED})""",
    # Tabs: keys, and the number that spreads their states.
    "t_lines": """SELECT *, CASE WHEN n % 23 <> 0 THEN document_number || item || line_id END AS key
      FROM (SELECT document_number, item, line_id, min(k) AS n FROM lg GROUP BY ALL)""",
    "t_articles": """SELECT *, CASE WHEN n % 23 <> 0 THEN document_number || item END AS key FROM (SELECT document_number, item, min(k) AS n FROM lg GROUP BY ALL)""",
    "t_batches": f"SELECT o_orderkey AS n, CASE WHEN o_orderkey % 46 <> 0 THEN {_batch('o_orderkey')} END AS key FROM orders WHERE o_orderkey % 2 = 0",
    "t_ships": "SELECT shipment_number AS key, min(k) AS n FROM lg GROUP BY shipment_number",
    "t_bills": f"""SELECT p_partkey AS n, CASE WHEN p_partkey % 29 <> 0 THEN 'Bill #' || (p_partkey % 1000) END AS key,
        CASE WHEN p_partkey % 8 <> 0 THEN {_doc('p_partkey * 4')} END AS document_number, (['Pay','On Hold','Reject','Pay'])[p_partkey % 4 + 1] AS verdict FROM part WHERE p_partkey % 5 <> 1""",
}
_NEEDS = {name: {other for other in PIECES if f" {other} " in f" {sql.replace('(', ' ').replace(')', ' ').replace(chr(10), ' ')} "} for name, sql in PIECES.items()}


def _with(select: str, *more: str) -> str:
    """``select`` with the common tables that it reads; ``more`` are named besides."""
    words = f" {select.replace('(', ' ').replace(')', ' ').replace(chr(10), ' ')} "
    wanted, todo = set(), [name for name in PIECES if f" {name} " in words] + list(more)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += _NEEDS[name] - {name}
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in PIECES.items() if name in wanted) + "\n" + select


def _remark(note: str, otherwise: str, zero: str = "0") -> str:
    """The text shown for the tabs' notes, blanks and zeros, by number."""
    blank = f"'No {otherwise} Mentioned'"
    first = f"'{zero}'" if zero else blank
    return f"(['{note}', {blank}, {blank}, {blank}, {first}, '{note} again'])[n % 6 + 1]"


def _tab(tracker: str, source: str, every: int, **values: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{tracker}' AS tracker, key, '{field}' AS field, {value} AS value FROM {source} WHERE n % {every} <> 1 AND key IS NOT NULL"
        for field, value in values.items())


_PACKING = "(['EAN Pending','SCM Check Pending','Compliance Check Pending','Label Creation Pending','Labels Not Required','Other',NULL])[n % 7 + 1]"
_L2 = "(['06a. EAN Pending','06b. SCM Check Pending','06c. Compliance Check Pending','06d. Label Creation Pending','','06b. SCM Check Pending','06b. SCM Check Pending'])[n % 7 + 1]"
_FOB = "CAST((['1998-05-01 00:00:00', (['1998-05-02 00:00:00', '1998-05-03 00:00:00', NULL])[n % 3 + 1]])[CASE WHEN n % 5 = 0 THEN 1 ELSE 2 END] AS VARCHAR)"
_SETTLED = "CASE WHEN n % 3 <> 0 OR n % 4 = 0 THEN 'Yes' ELSE 'No' END"
_SUPPLIER = "CASE WHEN n % 4 = 0 THEN 'Released' ELSE 'Not Released' END"
_SUPPLIER_REMARK = "(['Green1:Released by Supplier(Copy BOL available on VP)','Waiting','No Telex Blocker Mentioned','No Telex Blocker Mentioned'])[n % 4 + 1]"
_FFW = "(['Released','Not Released',NULL])[n % 3 + 1]"
_COMPLIANCE = f"CASE WHEN n % 5 = 0 THEN 'Compliance Blocker Resolved' ELSE {_remark('Compliance note', 'Compliance Blocker')} END"
_FFW_REMARK = _remark("FFW note", "FFW Telex Blocker")

TABS = {
    "tracker_telex": [
        ("telex_ffw", "t_ships", 7, {"ffw_sheet": _FFW, "telex_remark": _FFW_REMARK}),
        ("telex_supplier", "t_ships", 5, {"supplier_sheet": _SUPPLIER, "telex_remark": _SUPPLIER_REMARK})],
    "tracker_fob": [("fob", "t_batches", 3, {"fob_date": _FOB, "fob_status": "'Not Picked'"})],
    "tracker_packaging": [("packaging", "t_articles", 4, {
        "packaging_pending": f"CASE WHEN {_PACKING} = 'Labels Not Required' THEN 'No' ELSE 'Yes' END", "packaging_l2": _L2,
        "packaging_check": f"CASE WHEN {_PACKING} = 'Labels Not Required' THEN 'No' WHEN coalesce({_PACKING}, 'Other') = 'Other' THEN '' ELSE 'Yes' END"})],
    "tracker_payrun": [("payrun", "t_bills", 5, {"document_number": "document_number", "payrun_status": "verdict"})],
    "tracker_compliance": [("l2_compliance", "t_lines", 2, {"l2_compliance": _COMPLIANCE})],
    "tracker_line_remarks": [
        ("l2_prd", "t_lines", 3, {"l2_prd": _remark("PRD note", "PRD Blocker")}), ("l2_cprd", "t_lines", 4, {"l2_cprd": _remark("CPRD note", "CPRD Blocker")}),
        ("l2_qc", "t_lines", 6, {"l2_qc": _remark("QC note", "QC Blocker")}), ("l2_g2", "t_lines", 5, {"l2_g2": _remark("G2 note", "G2 Blocker", "")})],
    "tracker_batch_remarks": [
        ("spd_blockers", "t_batches", 4, {"l2_spd": _remark("SPD note", "SPD Blocker", "")}), ("g4", "t_batches", 3, {"l2_g4": _remark("G4 note", "G4 Blocker", "")}),
        ("ffw_status", "t_batches", 5, {"l2_pickup": _remark("FFW note", "FFW Comment")})],
    "tracker_forwarder_blockers": [("ffw_blockers", "t_batches", 7, {"ffw_blocker": _SETTLED})],
}
_PREPAYMENT = f"""SELECT 'prepayment' AS tracker, {_doc('n')} AS key, 'l2_pi' AS field, {_remark('PI note', 'PI Blocker')} AS value
    FROM (SELECT o_orderkey AS n FROM orders) WHERE n % 4 <> 1"""
_TRANSPARENCY = """SELECT 'transparency_requests' AS tracker, key, 'transparency_pending' AS field, CASE WHEN n % 3 = 0 THEN 'Yes' ELSE 'No' END AS value
      FROM t_articles WHERE n % 3 <> 1 AND key IS NOT NULL
    UNION ALL SELECT 'transparency_requests', key, 'transparency_pending', 'Yes' FROM t_articles WHERE n % 3 <> 1 AND key IS NOT NULL
    UNION ALL SELECT DISTINCT 'transparency_master', 'AS' || (p_partkey % 300), 'transparency_check', 'Yes' FROM part WHERE p_partkey % 300 % 4 = 0"""


def _side(source: str, key: str, every: int, **values: str) -> str:
    """One row per key of a tab, as the report looks it up."""
    columns = ", ".join(f"{value} AS {out}" for out, value in values.items())
    return f"(SELECT key AS {key}, {columns} FROM {source} WHERE n % {every} <> 1 AND key IS NOT NULL)"


#: The open lines with all that is looked up for them.
_LOOKED_UP = f"""ln AS (
  SELECT p.* EXCLUDE (l_suppkey, id), p.l_suppkey AS vendor_id, document_number || item || line_id AS line_key, document_number || item AS article_key,
    CASE WHEN first_prd <= planned_prd + INTERVAL 7 DAY THEN 'No Delay' WHEN prd_status IN ('Auto-approved', 'Approved by IM') OR first_prd IS NULL THEN 'Agreed'
      WHEN prd <= accepted_prd + INTERVAL 7 DAY THEN 'Agreed' ELSE 'SM Action Pending' END AS prd_delay_decision,
    ([30.0, 100.0, 0.0, NULL])[p.l_suppkey % 4 + 1] AS pi, ([20.0, 0.0, 0.0, NULL])[p.l_suppkey % 4 + 1] AS ci,
    ([60, 0, 45, 0])[p.l_suppkey % 4 + 1] AS bl_days, CASE WHEN invoice_status = 'Bill:Paid In Full' THEN 'Paid' ELSE 'Not Paid' END AS line_payment_status,
    coalesce(TRY_CAST(substr(quality_control_status, 1, 1) AS INTEGER), 1) AS qc_stage
  FROM po_lines p),
shipped_last AS (
  SELECT po AS document_number, item, line_id, shipment_number, status AS shipment_status, substatus, shipment_method, picked AS shipment_pickup_date,
    shipped AS shipment_shipping_date, expected_arrival_date, actual_arrival_date, actual_delivery_date FROM shipments
  QUALIFY row_number() OVER (PARTITION BY po, item, line_id ORDER BY line_snapshot_date DESC, header_snapshot_date DESC, shipment_number DESC) = 1),
vp AS (SELECT document_number, vp_pi_status FROM pi_invoices WHERE document_number IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY document_number ORDER BY moment DESC, vendor_po DESC, kind DESC) = 1),
l2 AS (
  SELECT ln.*, CASE WHEN pi = 100 THEN 'PI' WHEN pi + ci = 100 THEN 'CI' ELSE 'BL' END AS line_payment_type,
    CASE WHEN trim(ln.invoice_number) <> '' OR bl_days <> 0 THEN 'Submitted' ELSE 'Not Submitted' END AS line_invoice_submission,
    CASE WHEN qc_stage IN (3, 6) THEN 'No' ELSE 'Yes' END AS qc_pending, shipment_number, shipment_status, substatus, shipment_method, shipment_pickup_date,
    shipment_shipping_date, expected_arrival_date, actual_arrival_date, actual_delivery_date,
    coalesce(CASE WHEN st.document_number IS NOT NULL THEN 'Paid In Full' END, ns_pi_status, 'Not Submitted') AS ns_pi_status,
    coalesce(vp_pi_status, '03. PI Upload Pending') AS vp_pi_status, coalesce(pay.verdict, 'Not In Payment Sheet') AS pi_payment_status,
    coalesce(l2_pi, 'Not in PI Sheet') AS l2_pi, CASE WHEN sc.document_number IS NOT NULL THEN 'Available on VP' ELSE 'Not Available on VP' END AS supplier_vp_check,
    coalesce(l2_compliance, 'Not in Compliance Sheet') AS l2_compliance, coalesce(l2_prd, 'Not in PRD Sheet') AS l2_prd,
    coalesce(l2_cprd, 'Not in CPRD Sheet') AS l2_cprd, coalesce(l2_g2, 'Not in G2 Sheet') AS l2_g2, coalesce(l2_qc, 'Not in QC Sheet') AS l2_qc,
    coalesce(transparency_pending, 'Missing') AS transparency_pending, coalesce(packaging_pending, 'Yes') AS packaging_pending, packaging_l2,
    coalesce(tm.s, 'No') AS transparency_check, coalesce(r_name, 'Other') AS placement_batch, coalesce('owner_' || (s_suppkey % 7), '') AS cm,
    coalesce('owner_' || (s_suppkey % 5), '') AS sm, CASE WHEN s_nationkey % 3 = 0 THEN 'China' ELSE 'Other' END AS vendor_country,
    (['EU','US','CN'])[s_nationkey % 3 + 1] AS vendor_team, coalesce(co.compliance_status, 'Missing') AS compliance_status,
    coalesce(md_blocker, 'No Blocker') AS md_blocker, batch_booking, b.incoterms AS batch_incoterms, coalesce(scrd_delay_reasons, '') AS spd_delay_reason, scr_date AS spd,
    actual_pickup_date, gate_in_date, actual_shipping_date, coalesce(batch_sign_off, '14a. Documents Missing') AS batch_sign_off,
    CAST(fob_date AS TIMESTAMP) AS fob_date, coalesce(l2_g4, 'Not in G4 Sheet') AS l2_g4, coalesce(l2_spd, 'Not in SPD Sheet') AS l2_spd,
    coalesce(l2_pickup, 'Not in FFW Sheet') AS l2_pickup, coalesce(ffw_blocker, 'No') AS ffw_blocker,
    coalesce(bill.verdict, CASE WHEN line_payment_status = 'Paid' THEN 'Pay' ELSE 'Not In Payment Sheet' END) AS line_payment_approval
  FROM ln
  LEFT JOIN shipped_last USING (document_number, item, line_id)
  LEFT JOIN (SELECT {_doc('o_orderkey')} AS document_number FROM orders WHERE o_orderkey % 50 = 0) st USING (document_number)
  LEFT JOIN pi_status USING (document_number) LEFT JOIN vp USING (document_number)
  LEFT JOIN (SELECT * FROM t_bills WHERE key IS NOT NULL AND document_number IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY document_number ORDER BY n) = 1) pay USING (document_number)
  LEFT JOIN (SELECT key AS document_number, value AS l2_pi FROM ({_PREPAYMENT})) USING (document_number)
  LEFT JOIN supplier_confirmation sc USING (document_number)
  LEFT JOIN {_side('t_lines', 'line_key', 2, l2_compliance=_COMPLIANCE)} USING (line_key)
  LEFT JOIN {_side('t_lines', 'line_key', 3, l2_prd=_remark('PRD note', 'PRD Blocker'))} USING (line_key)
  LEFT JOIN {_side('t_lines', 'line_key', 4, l2_cprd=_remark('CPRD note', 'CPRD Blocker'))} USING (line_key)
  LEFT JOIN {_side('t_lines', 'line_key', 5, l2_g2=_remark('G2 note', 'G2 Blocker', ''))} USING (line_key)
  LEFT JOIN {_side('t_lines', 'line_key', 6, l2_qc=_remark('QC note', 'QC Blocker'))} USING (line_key)
  LEFT JOIN {_side('t_articles', 'article_key', 3, transparency_pending="CASE WHEN n % 3 = 0 THEN 'Yes' ELSE 'No' END")} USING (article_key)
  LEFT JOIN {_side('t_articles', 'article_key', 4, packaging_pending=f"CASE WHEN {_PACKING} = 'Labels Not Required' THEN 'No' ELSE 'Yes' END", packaging_l2=_L2)} USING (article_key)
  LEFT JOIN (SELECT DISTINCT 'AS' || (p_partkey % 300) AS asin, 'Yes' AS s FROM part WHERE p_partkey % 300 % 4 = 0) tm USING (asin)
  LEFT JOIN region ON ln.memo = 'memo_' || r_regionkey LEFT JOIN supplier ON ln.vendor_id = s_suppkey
  LEFT JOIN compliance co USING (item, marketplace, vendor_id) LEFT JOIN master_data USING (item, marketplace)
  LEFT JOIN batches b USING (batch_id) LEFT JOIN packing_lists USING (batch_id)
  LEFT JOIN {_side('t_batches', 'batch_id', 3, fob_date=_FOB, l2_g4=_remark('G4 note', 'G4 Blocker', ''))} USING (batch_id)
  LEFT JOIN {_side('t_batches', 'batch_id', 4, l2_spd=_remark('SPD note', 'SPD Blocker', ''))} USING (batch_id)
  LEFT JOIN {_side('t_batches', 'batch_id', 5, l2_pickup=_remark('FFW note', 'FFW Comment'))} USING (batch_id)
  LEFT JOIN {_side('t_batches', 'batch_id', 7, ffw_blocker=_SETTLED)} USING (batch_id)
  LEFT JOIN (SELECT * FROM t_bills WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY key ORDER BY n) = 1) bill ON ln.invoice_number = bill.key)"""
_READ = [name for name in PIECES if f" {name} " in f" {_LOOKED_UP.replace('(', ' ').replace(')', ' ').replace(chr(10), ' ')} "] + ["telex", "t_ships"]
_TELEX_SIDES = f"""(SELECT * FROM telex FULL JOIN {_side('t_ships', 'shipment_number', 7, ffw_sheet=_FFW, ffw_remark=_FFW_REMARK)} USING (shipment_number)
  FULL JOIN {_side('t_ships', 'shipment_number', 5, supplier_sheet=_SUPPLIER, supplier_remark=_SUPPLIER_REMARK)} USING (shipment_number))"""
_RELEASES = (
    "(telex_ffw_date IS NOT NULL OR coalesce(ffw_sheet = 'Released', FALSE))", "(telex_supplier_date IS NOT NULL)", "coalesce(supplier_sheet = 'Released', FALSE)",
)
_REMARKS = ("coalesce(supplier_remark, 'Not in Telex Sheet')", "coalesce(ffw_remark, 'Not in FFW Telex Sheet')")


def _whole(rest: str) -> str:
    """``rest`` after the common tables that the looked-up lines and the telex sides read."""
    return _with("", *_READ).rstrip() + ",\n" + rest


_ENRICHED = """line_key, shipment_number, shipment_status, batch_booking, spd, batch_sign_off, vp_pi_status, ns_pi_status, md_blocker, compliance_status,
  supplier_vp_check, transparency_pending, packaging_l2, pi_payment_status, line_payment_approval, l2_prd, l2_compliance, l2_g2, l2_g4, l2_spd, l2_pickup,
  l2_pi, l2_qc, l2_cprd, ffw_blocker, fob_date"""
_REPORTED = """line_key, batch_payment_type, inb_payment_type, batch_qc_pending, batch_pickup_status, shipping_status, supplier_telex, current_status, sub_code, final_team"""

CONTRACT = """
WITH lines AS (
  SELECT o_orderkey AS o, CASE WHEN o_orderkey % 83 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS key, o_orderstatus AS status,
    CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price,
    strftime(o_orderdate, '%Y-%m-%d') AS day, CASE WHEN o_orderkey % 5 = 0 THEN '"a ""b"", c"' ELSE '' END AS note FROM orders
), whole AS (SELECT *, key || ',' || status || ',' || price || ',' || day || ',' || note AS line FROM lines),
cut AS (
  SELECT *, CASE WHEN o % 89 = 0 THEN key || ',' || status WHEN o % 79 = 0 THEN line || ',too many' ELSE line END AS text,
    CASE WHEN o % 89 = 0 OR o % 79 = 0 OR o % 97 = 0 THEN 'broken line' WHEN o % 83 = 0 THEN 'no key' ELSE 'good' END AS part FROM whole
)
SELECT part, CASE part WHEN 'broken line' THEN text WHEN 'good' THEN key || '|' || status || '|' || price || '|' || day
  || CASE WHEN o % 5 = 0 THEN '|a "b", c' ELSE '' END END AS content FROM cut
"""

ORACLE = {
    "source_contract": CONTRACT,
    "pull_po_lines": _with("""SELECT document_number, line_id, id, item, final_status, memo, quantity, quantity_received, date_created, first_prd, accepted_prd, batch_id,
        snapshot_datetime FROM po_lines """),
    "pull_packing_lists": _with("SELECT * FROM packing_lists "),
    "pull_batches": _with("SELECT * FROM batches "),
    "pull_shipments": _with("""SELECT shipment_number, po, line_id, shipped_line_id, item, status, substatus, quantity_expected, quantity_remaining, actual_arrival_date,
        line_snapshot_date FROM shipments """),
    "pull_shipment_star": _with("SELECT * FROM star "),
    "pull_telex": _with("SELECT * FROM telex "),
    "pull_pi_invoices": _with("SELECT * FROM pi_invoices "),
    "pull_pi_status": _with("SELECT * FROM pi_status "),
    "pull_supplier_confirmation": _with("SELECT * FROM supplier_confirmation "),
    "pull_master_data": _with("SELECT * FROM master_data "),
    "pull_compliance": _with("SELECT * FROM compliance "),
    "pull_stage_dates": _with("SELECT * FROM stage_dates "),
    **{name: _with(" UNION ALL ".join(_tab(tracker, source, every, **values) for tracker, source, every, values in parts)) for name, parts in TABS.items()},
    "tracker_prepayment": _PREPAYMENT,
    "tracker_transparency": _with(_TRANSPARENCY),
    "report_inputs": _whole(_LOOKED_UP + f"\nSELECT {_ENRICHED} FROM l2"),
    "report_from_raw": _whole(stage(groups(_LOOKED_UP, _TELEX_SIDES, "supplier_remark, ffw_remark, NULL", _RELEASES), _REMARKS) + f"\nSELECT {_REPORTED} FROM l16"),
}
