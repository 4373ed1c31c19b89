"""SQL for the status report, written from the rules."""

from __future__ import annotations

from ordertide.plans.status import full_columns

NOW = "TIMESTAMP '1998-06-01 12:00:00'"

BASE = """
lg AS (
  SELECT *, l_orderkey * 7 + l_linenumber * 5 + l_partkey * 3 + l_suppkey AS k,
    'PO' || l_orderkey AS document_number, CAST(l_linenumber AS VARCHAR) AS line_id, 'IT' || l_partkey AS item,
    'AS' || (l_partkey % 300) AS asin,
    (['US','DE','FR','MX','BR','CO','UK','US'])[(l_orderkey * 7 + l_linenumber * 5 + l_partkey * 3 + l_suppkey) % 8 + 1] AS marketplace,
    l_suppkey AS vendor_id, 'S' || l_suppkey || '-' || strftime(l_shipdate, '%Y%m') AS shipment_number
  FROM lineitem),
po0 AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lg) LEFT JOIN orders ON l_orderkey = o_orderkey
  WHERE rn = 1),
po AS (
  SELECT document_number, line_id, item, asin, marketplace, l_orderkey, l_linenumber, k, vendor_id,
    document_number || item || line_id AS line_key,
    l_suppkey || ' Vendor' AS po_vendor,
    CASE WHEN k % 6 = 1 THEN 'import_ic_flow' WHEN k % 6 > 1 THEN 'memo_' || (k % 6) END AS memo,
    (['100% PI','30% PI 70% CI','30% PI 20% CI 50% BL 60','0% PI 100% BL BL 30','0% PI 100% CI',NULL])[l_suppkey % 6 + 1] AS supplier_payment_terms,
    (['Pending Confirmation','Rejected','Confirmed','Confirmed','Confirmed'])[k % 5 + 1] AS supplier_confirmation_status,
    CASE WHEN o_orderkey IS NULL AND l_linenumber = 1 THEN NULL
      WHEN o_orderstatus = 'F' AND l_returnflag = 'R' THEN 'Closed'
      WHEN k % 11 = 0 THEN 'Pending Supervisor Approval' WHEN k % 11 = 1 THEN 'Rejected By Supervisor' ELSE 'Open' END AS final_status,
    'PO' || l_orderkey || '-' || l_linenumber AS id, (['Brand A', 'Brand B', NULL])[k % 3 + 1] AS associated_brands,
    (['FOB', 'EXW', 'DDP'])[k % 3 + 1] AS incoterms,
    CASE k % 4 WHEN 1 THEN CAST(l_quantity AS BIGINT) // 2 WHEN 2 THEN CAST(l_quantity AS BIGINT) ELSE 0 END // 2 AS quantity_on_shipments,
    CASE WHEN k % 4 = 0 THEN 'Yes' ELSE 'No' END AS sm_line_signoff,
    CAST(l_quantity AS BIGINT) AS quantity,
    CASE k % 4 WHEN 1 THEN CAST(l_quantity AS BIGINT) // 2 WHEN 2 THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS quantity_received,
    l_extendedprice AS item_rate_eur, o_orderdate AS date_created,
    CASE WHEN k % 7 <> 0 THEN l_shipdate + to_days(CAST(k % 20 - 5 AS INTEGER)) END AS first_prd,
    CASE WHEN k % 13 <> 0 THEN l_shipdate + to_days(CAST(k % 9 AS INTEGER)) END AS planned_prd,
    CASE WHEN k % 10 <> 0 THEN l_shipdate + to_days(CAST(k % 50 - 10 AS INTEGER)) END AS prd,
    CASE WHEN k % 6 <> 0 THEN l_shipdate + to_days(CAST(k % 15 AS INTEGER)) END AS accepted_prd,
    (['Auto-approved','Approved by IM','Requested','Requested'])[k % 4 + 1] AS prd_status,
    CASE WHEN k % 5 <> 0 THEN l_shipdate + to_days(CAST(k % 30 AS INTEGER)) END AS confirmed_crd,
    CASE WHEN k % 4 <> 0 THEN l_shipdate + to_days(CAST(k % 12 AS INTEGER)) END AS quality_control_date,
    (['1. Open','3. Passed','6. Waived','x','2. Planned'])[k % 5 + 1] AS quality_control_status,
    CASE WHEN k % 3 = 0 THEN 'Yes' ELSE 'No' END AS im_line_signoff,
    (['Cargo Picked(SM)','Ready for batching','Ready for batching','In production','Planned'])[k % 5 + 1] AS production_status,
    CASE WHEN l_linenumber < 6 THEN 'B' || (l_orderkey - l_orderkey % 2) END AS batch_id,
    CASE WHEN k % 2 = 0 THEN 'AMZ' ELSE '3PL' END AS wh_type,
    CASE WHEN k % 17 = 0 THEN 'Yes' ELSE 'No' END AS considered_anti_po,
    CASE WHEN k % 3 = 0 THEN 'No' ELSE 'Yes' END AS prd_reconfirmation,
    CASE WHEN k % 4 <> 0 THEN 'Bill #' || (k % 1000) END AS invoice_number,
    CASE WHEN k % 3 = 0 THEN 'Bill:Paid In Full' ELSE 'Bill:Open' END AS invoice_status
  FROM po0)"""

LINES = BASE + """,
shipments AS (
  SELECT document_number, item, line_id, shipment_number,
    (['To Be Shipped','In Transit','Received','Partially Received','Planned'])[k % 5 + 1] AS shipment_status,
    CASE WHEN k % 3 = 0 THEN 'Delivered' ELSE 'Open' END AS substatus,
    CASE WHEN k % 2 = 0 THEN 'Ocean' ELSE 'Air' END AS shipment_method,
    CASE WHEN k % 3 <> 1 THEN l_shipdate + INTERVAL 3 DAY END AS shipment_pickup_date,
    CASE WHEN k % 4 IN (1, 2) THEN l_shipdate + INTERVAL 5 DAY END AS shipment_shipping_date,
    CASE WHEN k % 5 <> 0 THEN l_shipdate + INTERVAL 38 DAY END AS expected_arrival_date,
    CASE WHEN k % 4 = 2 THEN l_shipdate + INTERVAL 35 DAY END AS actual_arrival_date,
    CASE WHEN k % 8 = 2 THEN l_shipdate + INTERVAL 45 DAY END AS actual_delivery_date
  FROM lg WHERE l_returnflag <> 'N'
  QUALIFY row_number() OVER (PARTITION BY document_number, item, line_id
    ORDER BY l_shipdate, l_suppkey, l_extendedprice, l_quantity) = 1),
batches AS (
  SELECT 'B' || o_orderkey AS batch_id, o_orderkey // 2 AS b, o_orderdate AS day FROM orders WHERE o_orderkey % 2 = 0),
ln AS (
  SELECT po.* EXCLUDE (vendor_id), CAST(split_part(po_vendor, ' ', 1) AS BIGINT) AS vendor_id,
    CASE WHEN marketplace IN ('CO', 'MX', 'BR') THEN 'LATAM' ELSE marketplace END AS mp,
    quantity - quantity_received AS pending_units, item_rate_eur * (quantity - quantity_received) AS pending_value,
    CASE WHEN first_prd <= planned_prd + INTERVAL 7 DAY THEN 'No Delay'
      WHEN prd_status IN ('Auto-approved', 'Approved by IM') OR first_prd IS NULL THEN 'Agreed'
      WHEN prd <= accepted_prd + INTERVAL 7 DAY THEN 'Agreed' ELSE 'SM Action Pending' END AS prd_delay_decision,
    TRY_CAST(nullif(regexp_extract(supplier_payment_terms, '(\\d+)% PI', 1), '') AS DOUBLE) AS pi,
    TRY_CAST(nullif(regexp_extract(supplier_payment_terms, '(\\d+)% CI', 1), '') AS DOUBLE) AS ci,
    TRY_CAST(nullif(regexp_extract(supplier_payment_terms, '(\\d+)% BL', 1), '') AS DOUBLE) AS bl,
    CASE WHEN TRY_CAST(nullif(regexp_extract(supplier_payment_terms, 'BL (\\d+)', 1), '') AS INTEGER) >= 45
      THEN TRY_CAST(nullif(regexp_extract(supplier_payment_terms, 'BL (\\d+)', 1), '') AS INTEGER) ELSE 0 END AS bl_days,
    CASE WHEN invoice_status = 'Bill:Paid In Full' THEN 'Paid' ELSE 'Not Paid' END AS line_payment_status,
    coalesce(TRY_CAST(substr(quality_control_status, 1, 1) AS INTEGER), 1) AS qc_stage
  FROM po
  WHERE final_status NOT IN ('Closed', 'Legacy Closed', 'Fully Billed') AND quantity - quantity_received > 0
    AND (memo IS NULL OR memo <> 'import_ic_flow')),
l1 AS (
  SELECT ln.*,
    CASE WHEN pi = 100 THEN 'PI' WHEN pi + ci = 100 THEN 'CI' ELSE 'BL' END AS line_payment_type,
    CASE WHEN trim(invoice_number) <> '' OR bl_days <> 0 THEN 'Submitted' ELSE 'Not Submitted' END AS line_invoice_submission,
    CASE WHEN qc_stage IN (3, 6) THEN 'No' ELSE 'Yes' END AS qc_pending,
    shipment_number, shipment_status, substatus, shipment_method, shipment_pickup_date, shipment_shipping_date,
    expected_arrival_date, actual_arrival_date, actual_delivery_date
  FROM ln LEFT JOIN shipments USING (document_number, item, line_id))"""


def _tracker(source: str, number: str, keys: str, every: int, name: str, out: str) -> str:
    return (
        f"(SELECT {keys}, min(CASE WHEN {number} % 2 = 0 THEN 'No {name} Blocker Mentioned' ELSE '{name} note' END)"
        f" AS {out} FROM {source} WHERE {number} % {every} = 0 GROUP BY ALL)"
    )


_DOC = "(SELECT *, 'PO' || o_orderkey AS document_number FROM orders)"
_ART = "(SELECT DISTINCT document_number, item, l_orderkey + l_partkey AS n FROM lg)"
_SHIP = "(SELECT DISTINCT shipment_number, l_suppkey + month(l_shipdate) AS n FROM lg)"
_NUM = "(l_orderkey + l_linenumber)"
_LINE = "document_number, item, line_id"

LOOKUPS = LINES + f""",
l2 AS (
  SELECT l1.*,
    coalesce(st.s, pis.s, 'Not Submitted') AS ns_pi_status, coalesce(vp.s, '03. PI Upload Pending') AS vp_pi_status,
    coalesce(prd_.s, 'Not In Payment Sheet') AS pi_payment_status, coalesce(l2_pi, 'Not in PI Sheet') AS l2_pi,
    CASE WHEN sc.document_number IS NOT NULL THEN 'Available on VP' ELSE 'Not Available on VP' END AS supplier_vp_check,
    coalesce(l2_compliance, 'Not in Compliance Sheet') AS l2_compliance, coalesce(l2_prd, 'Not in PRD Sheet') AS l2_prd,
    coalesce(l2_cprd, 'Not in CPRD Sheet') AS l2_cprd, coalesce(l2_g2, 'Not in G2 Sheet') AS l2_g2,
    coalesce(l2_qc, 'Not in QC Sheet') AS l2_qc,
    coalesce(tr.s, 'Missing') AS transparency_pending, coalesce(pk.s, 'Yes') AS packaging_pending, pk.l2 AS packaging_l2,
    coalesce(tm.s, 'No') AS transparency_check, coalesce(r_name, 'Other') AS placement_batch,
    coalesce('owner_' || (s_suppkey % 7), '') AS cm, coalesce('owner_' || (s_suppkey % 5), '') AS sm,
    CASE WHEN s_nationkey % 3 = 0 THEN 'China' ELSE 'Other' END AS vendor_country,
    (['EU','US','CN'])[s_nationkey % 3 + 1] AS vendor_team,
    coalesce(co.s, 'Missing') AS compliance_status,
    coalesce(CASE WHEN l1.marketplace = 'US' THEN (['No Blocker','Reroute or Cancel','Wait'])[p_size % 3 + 1] END, 'No Blocker') AS md_blocker,
    CASE WHEN b % 5 = 0 THEN 'Not Booked' WHEN b % 5 <> 1 THEN 'Booked' WHEN b % 3 <> 0 THEN 'Booked'
      WHEN b IS NOT NULL THEN 'Not Booked' END AS batch_booking,
    (['FOB','EXW','DDP','DAP','FCA'])[b % 5 + 1] AS batch_incoterms,
    CASE WHEN b % 6 <> 0 THEN day + to_days(CAST(b % 120 AS INTEGER)) END AS spd,
    coalesce((['Truck late', NULL, 'Documents late'])[b % 3 + 1], '') AS spd_delay_reason,
    coalesce(CASE WHEN b % 3 = 0 THEN (['Released', 'Waiting', NULL, 'Waiting'])[b % 4 + 1] END, '') AS fob_status,
    CASE WHEN b % 4 = 0 THEN day + INTERVAL 60 DAY END AS actual_pickup_date,
    CASE WHEN b % 8 = 1 THEN day + INTERVAL 70 DAY END AS gate_in_date,
    CASE WHEN b % 8 = 5 THEN day + INTERVAL 80 DAY END AS actual_shipping_date,
    coalesce(CASE WHEN b % 5 <> 0 THEN (['Signed-Off','Signed-Off','14a. Documents Missing','14b. SM Sign-Off Missing',
      '14c. FFW Sign-Off Missing','Signed-Off'])[b % 6 + 1] END, '14a. Documents Missing') AS batch_sign_off,
    CASE WHEN b % 3 = 0 AND b % 9 <> 0 THEN day + INTERVAL 75 DAY END AS fob_date,
    coalesce(CASE WHEN b % 3 = 0 THEN CASE WHEN b % 2 = 0 THEN 'No G4 Blocker Mentioned' ELSE 'G4 note' END END, 'Not in G4 Sheet') AS l2_g4,
    coalesce(CASE WHEN b % 4 = 0 THEN CASE WHEN b % 2 = 0 THEN 'No SPD Blocker Mentioned' ELSE 'SPD note' END END, 'Not in SPD Sheet') AS l2_spd,
    coalesce(CASE WHEN b % 5 = 0 THEN CASE WHEN b % 2 = 0 THEN 'No FFW Blocker Mentioned' ELSE 'FFW note' END END, 'Not in FFW Sheet') AS l2_pickup,
    coalesce(CASE WHEN b % 7 = 0 THEN (['Yes','No','No truck'])[b % 3 + 1] END, 'No') AS ffw_blocker,
    coalesce(pi_.s, CASE WHEN line_payment_status = 'Paid' THEN 'Pay' ELSE 'Not In Payment Sheet' END) AS line_payment_approval
  FROM l1
  LEFT JOIN (SELECT document_number, 'Paid In Full' AS s FROM {_DOC} WHERE o_orderkey % 50 = 0) st USING (document_number)
  LEFT JOIN (SELECT document_number, (['Paid In Full','Pending Approval','Open','Open'])[o_orderkey % 4 + 1] AS s
    FROM {_DOC} WHERE o_orderkey % 3 <> 0) pis USING (document_number)
  LEFT JOIN (SELECT document_number, (['03. PI Upload Pending','04a. SM Review Pending','05a. Approved'])[o_orderkey % 3 + 1] AS s
    FROM {_DOC} WHERE o_orderkey % 4 <> 1) vp USING (document_number)
  LEFT JOIN (SELECT document_number, (['Pay','On Hold','Reject','Yes'])[o_orderkey % 4 + 1] AS s
    FROM {_DOC} WHERE o_orderkey % 5 = 0) prd_ USING (document_number)
  LEFT JOIN (SELECT document_number FROM {_DOC} WHERE o_orderkey % 3 <> 1) sc USING (document_number)
  LEFT JOIN {_tracker(_DOC, 'o_orderkey', 'document_number', 4, 'PI', 'l2_pi')} USING (document_number)
  LEFT JOIN {_tracker('lg', _NUM, _LINE, 2, 'Compliance', 'l2_compliance')} USING ({_LINE})
  LEFT JOIN {_tracker('lg', _NUM, _LINE, 3, 'PRD', 'l2_prd')} USING ({_LINE})
  LEFT JOIN {_tracker('lg', _NUM, _LINE, 4, 'CPRD', 'l2_cprd')} USING ({_LINE})
  LEFT JOIN {_tracker('lg', _NUM, _LINE, 5, 'G2', 'l2_g2')} USING ({_LINE})
  LEFT JOIN {_tracker('lg', _NUM, _LINE, 6, 'QC', 'l2_qc')} USING ({_LINE})
  LEFT JOIN (SELECT document_number, item, CASE WHEN n % 2 = 0 THEN 'Yes' ELSE 'No' END AS s FROM {_ART} WHERE n % 3 = 0) tr
    USING (document_number, item)
  LEFT JOIN (SELECT document_number, item, CASE WHEN n % 5 = 0 THEN 'Yes' ELSE 'No' END AS s,
      (['06a. EAN Pending','06b. SCM Check Pending','06d. Label Creation Pending'])[n % 3 + 1] AS l2
    FROM {_ART} WHERE n % 4 <> 0) pk USING (document_number, item)
  LEFT JOIN (SELECT DISTINCT 'AS' || (p_partkey % 300) AS asin, 'Yes' AS s FROM part WHERE p_partkey % 300 % 4 = 0) tm USING (asin)
  LEFT JOIN region ON l1.memo = 'memo_' || r_regionkey
  LEFT JOIN supplier ON l1.vendor_id = s_suppkey
  LEFT JOIN (SELECT item, marketplace, vendor_id,
      min((['Approved','Approved','Approved','Blocked','Pending'])[(l_partkey + l_suppkey) % 5 + 1]) AS s
    FROM lg WHERE l_partkey % 4 <> 0 GROUP BY ALL) co USING (item, marketplace, vendor_id)
  LEFT JOIN part ON l1.item = 'IT' || p_partkey
  LEFT JOIN batches USING (batch_id)
  LEFT JOIN (SELECT 'Bill #' || (p_partkey % 1000) AS invoice_number, min((['Pay','Pay','Pay','On Hold','Reject'])[p_size % 5 + 1]) AS s
    FROM part GROUP BY 1) pi_ USING (invoice_number))"""


def _group(prefix: str, key: str) -> str:
    def any_of(column: str, value: str, out: str) -> str:
        return (
            f"CASE WHEN {key} IS NOT NULL AND bool_or({column} = '{value}') OVER (PARTITION BY {key})"
            f" THEN '{value}' ELSE {column} END AS {out}"
        )
    approval = "line_payment_approval"
    return ", ".join([
        any_of("line_payment_type", "BL", f"{prefix}_payment_type"),
        any_of("line_invoice_submission", "Not Submitted", f"{prefix}_invoice_submission"),
        any_of("line_payment_status", "Not Paid", f"{prefix}_payment_status"),
        f"CASE WHEN {key} IS NULL THEN {approval}"
        f" WHEN bool_or({approval} = 'Reject') OVER (PARTITION BY {key}) THEN 'Reject'"
        f" WHEN bool_or({approval} = 'Not In Payment Sheet') OVER (PARTITION BY {key}) THEN 'Not In Payment Sheet'"
        f" WHEN bool_or({approval} <> 'Pay') OVER (PARTITION BY {key}) THEN 'On Hold' ELSE 'Pay' END AS {prefix}_payment_approval",
    ])


_MAX_QC = "max(quality_control_date) OVER (PARTITION BY batch_id)"
#: When forwarder, supply manager and supplier have released the shipment's telex, by the test tables' shipment number.
_RELEASES = (
    "coalesce(sh.n % 2 = 0 AND sh.n % 3 = 0, FALSE) OR coalesce(sh.n % 7 = 1, FALSE)",
    "coalesce(sh.n % 2 = 0 AND sh.n % 4 = 0, FALSE)", "coalesce(sh.n % 5 = 1, FALSE)",
)


def groups(lookups: str, ships: str, number: str, releases: tuple[str, str, str]) -> str:
    """Group statuses and what follows from them, after the looked-up lines ``l2``."""
    ffw, manager, supplier = releases
    return lookups + f""",
l3 AS (
  SELECT l2.*, {_group('batch', 'batch_id')}, {_group('inb', 'shipment_number')},
    CASE WHEN batch_id IS NOT NULL AND bool_or(qc_pending = 'Yes') OVER (PARTITION BY batch_id) THEN 'Yes' ELSE qc_pending END AS batch_qc_pending,
    CASE WHEN batch_id IS NOT NULL THEN {_MAX_QC} END AS max_qc_date,
    CASE WHEN batch_id IS NULL THEN 'No Batch' WHEN {_MAX_QC} IS NULL THEN 'Not Scheduled' ELSE 'Scheduled' END AS max_qc_state,
    CASE WHEN batch_id IS NULL THEN compliance_status
      WHEN bool_and(compliance_status = 'Approved') OVER (PARTITION BY batch_id) THEN 'Approved' ELSE 'Pending Approval' END AS group_compliance
  FROM l2),
l4 AS (
  SELECT l3.*, {number} AS sn, {ffw} AS ffw_done, {manager} AS sm_done, {supplier} AS supplier_done,
    CASE WHEN actual_pickup_date IS NOT NULL
        THEN CASE WHEN CAST(actual_pickup_date AS DATE) >= CAST({NOW} AS DATE) THEN 'Not Picked' ELSE 'Picked' END
      WHEN gate_in_date IS NOT NULL OR actual_shipping_date IS NOT NULL OR shipment_pickup_date IS NOT NULL
        OR actual_arrival_date IS NOT NULL OR actual_delivery_date IS NOT NULL
        OR shipment_status IN ('In Transit', 'Received', 'Partially Received') THEN 'Picked' ELSE 'Not Picked' END AS batch_pickup_status
  FROM l3 LEFT JOIN {ships} sh USING (shipment_number)),
l5 AS (
  SELECT *,
    CASE WHEN batch_pickup_status = 'Picked' THEN 'Booked' ELSE coalesce(batch_booking, 'Not Booked') END AS vp_booking_status,
    CASE WHEN shipment_number IS NOT NULL AND (shipment_shipping_date IS NOT NULL OR actual_arrival_date IS NOT NULL
        OR actual_delivery_date IS NOT NULL OR actual_shipping_date IS NOT NULL
        OR shipment_status IN ('In Transit', 'Received', 'Partially Received')) THEN 'Shipped' ELSE 'Not Shipped' END AS shipping_status,
    coalesce(actual_delivery_date, actual_arrival_date + INTERVAL 15 DAY, shipment_shipping_date + INTERVAL 40 DAY,
      shipment_pickup_date + INTERVAL 50 DAY, gate_in_date + INTERVAL 45 DAY, actual_pickup_date + INTERVAL 50 DAY,
      confirmed_crd + INTERVAL 45 DAY, planned_prd + INTERVAL 55 DAY, {NOW} + INTERVAL 100 DAY) AS estimated_delivery_date,
    CASE WHEN substatus = 'Delivered' THEN 'Released' WHEN shipment_number IS NULL THEN 'Not in INB Sheet'
      WHEN ffw_done THEN 'Released' ELSE 'Not Released' END AS ffw_telex,
    CASE WHEN substatus = 'Delivered' THEN 'Released' WHEN shipment_number IS NULL THEN 'Not in INB Sheet'
      WHEN ffw_done OR sm_done THEN 'Released' ELSE 'Not Released' END AS sm_telex,
    CASE WHEN substatus = 'Delivered' THEN 'Released' WHEN shipment_number IS NULL THEN 'Not in INB Sheet'
      WHEN ffw_done OR sm_done OR supplier_done THEN 'Released' ELSE 'Not Released' END AS supplier_telex,
    CASE WHEN batch_pickup_status = 'Picked' THEN 'Approved' ELSE group_compliance END AS batch_compliance,
    CASE WHEN vendor_country = 'China' AND marketplace = 'US' THEN 'CN->US' ELSE coalesce(vendor_team, '') END AS team,
    CASE WHEN batch_pickup_status <> 'Picked' AND md_blocker <> 'No Blocker' THEN 'Yes' ELSE 'No' END AS flag_d
  FROM l4),
l6 AS (
  SELECT l5.*, CASE WHEN team = 'CN->US' THEN coalesce('Priority ' || pr.n, 'Priority 3') ELSE 'Priority 3' END AS focus
  FROM l5 LEFT JOIN (SELECT 'AS' || (p_partkey % 300) AS asin, min(p_size % 2 + 1) AS n FROM part GROUP BY 1) pr USING (asin))"""


GROUPS = groups(LOOKUPS, _SHIP, "sh.n", _RELEASES)

_U = "batch_pickup_status <> 'Picked'"
FLAGS = {
    "a": f"{_U} AND considered_anti_po = 'Yes'",
    "b": f"{_U} AND compliance_status IN ('Blocked', 'Missing')",
    "c": f"{_U} AND shipping_status = 'Shipped'",
    "01": f"{_U} AND final_status IN ('Pending Supervisor Approval', 'Rejected By Supervisor')",
    "02": f"{_U} AND supplier_confirmation_status IS DISTINCT FROM 'Confirmed'",
    "03": f"{_U} AND ns_pi_status = 'Not Submitted' AND pi IS DISTINCT FROM 0 AND vp_pi_status = '03. PI Upload Pending'",
    "04": f"{_U} AND pi IS DISTINCT FROM 0 AND left(vp_pi_status, 2) <> '05' AND ns_pi_status = 'Not Submitted'",
    "05": f"""{_U} AND (pi_payment_status = 'Yes' OR (NOT (quantity_received = 100 AND batch_payment_status = 'Paid')
             AND pi_payment_status <> 'Paid In Full' AND quantity_received <> 0))""",
    "06": f"{_U} AND packaging_pending = 'Yes'",
    "07": f"{_U} AND transparency_check <> 'No' AND transparency_pending <> 'No'",
    "08": f"{_U} AND prd IS NULL",
    "09": f"{_U} AND (prd IS NULL OR prd - INTERVAL 21 DAY > {NOW})",
    "10": f"""{_U} AND (prd IS NULL OR prd - INTERVAL 21 DAY > {NOW} OR prd - INTERVAL 18 DAY > {NOW}
             OR prd_reconfirmation <> 'Yes')""",
    "11": f"{_U} AND NOT (im_line_signoff = 'Yes' AND compliance_status = 'Approved')",
    "12": f"{_U} AND production_status NOT IN ('Ready for batching', 'Cargo Picked(SM)')",
    "13": f"{_U} AND batch_id IS NULL",
    "14": f"{_U} AND batch_sign_off <> 'Signed-Off'",
    "15": f"{_U} AND batch_invoice_submission <> 'Submitted' AND batch_payment_type <> 'BL'",
    "16": f"{_U} AND batch_payment_status <> 'Paid' AND batch_payment_type <> 'BL'",
    "17": f"""{_U} AND batch_qc_pending <> 'No' AND (max_qc_state = 'Not Scheduled'
             OR max_qc_date > {NOW} - INTERVAL 1 DAY)""",
    "18": f"{_U} AND coalesce(batch_incoterms, '') NOT IN ('DAP', 'DDP') AND vp_booking_status <> 'Booked'",
    "19": f"{_U} AND (spd IS NULL OR spd > {NOW} + INTERVAL 7 DAY)",
    "20": f"""{_U} AND (batch_qc_pending = 'Yes' OR (batch_incoterms IS DISTINCT FROM 'FOB' AND spd > {NOW})
             OR (batch_incoterms = 'FOB' AND fob_date IS NULL))""",
    "21": f"{_U} AND batch_incoterms IN ('FOB', 'DAP', 'DDP')",
    "22": _U,
    "23": "shipment_number IS NULL",
    "24": "shipment_status = 'To Be Shipped'",
    "25": "inb_invoice_submission <> 'Submitted' AND inb_payment_type = 'BL'",
    "26": """inb_payment_status <> 'Paid' AND inb_payment_type = 'BL' AND substatus IS DISTINCT FROM 'Delivered'
             AND actual_arrival_date IS NULL""",
    "27": "inb_payment_status <> 'Paid' AND inb_payment_type = 'BL' AND substatus IS DISTINCT FROM 'Delivered'",
    "28": """shipment_method = 'Ocean' AND substatus IS DISTINCT FROM 'Delivered'
             AND (actual_arrival_date IS NULL OR ffw_telex <> 'Released')""",
    "29": "substatus IS DISTINCT FROM 'Delivered'",
    "30": "coalesce(shipment_status, '') NOT IN ('Received', 'Partially Received')",
    "31": "shipment_status IN ('Received', 'Partially Received')",
}
NAMES = {
    "a": "A. Anti PO Line", "b": "B. Compliance Blocked", "c": "C. Shipped", "01": "01. PO Approval Pending",
    "02": "02. Supplier Confirmation Pending", "03": "03. PI Upload Pending", "04": "04. PI Approval Pending",
    "05": "05. PI Payment Pending", "06": "06. Packaging Pending", "07": "07. Transparency Label Pending",
    "08": "08. PRD Pending", "09": "09. Under Production", "10": "10. PRD Confirmation Pending",
    "11": "11. IM Sign-Off Pending", "12": "12. Ready for Batching Pending", "13": "13. Batch Creation Pending",
    "14": "14. SM Sign-Off Pending", "15": "15. CI Approval Pending", "16": "16. CI Payment Pending",
    "17": "17. QC Schedule Pending", "18": "18. FFW Booking Missing", "19": "19. Supplier Pickup Date Pending",
    "20": "20. Pre Pickup Check", "21": "21. FOB Pickup Pending", "22": "22. Non FOB Pickup Pending",
    "23": "23. INB Creation Pending", "24": "24. Mark In-Transit Pending", "25": "25. BL Approval Pending",
    "26": "26. BL Payment Pending - In Transit", "27": "27. BL Payment Pending - Arrived",
    "28": "28. Telex Release Pending", "29": "29. Stock Delivery Pending", "30": "30. Stock Receiving Pending",
    "31": "31. Dispute - PO Closing Pending",
}
_FLAG_COLUMNS = ", ".join(f"CASE WHEN {test} THEN 'Yes' ELSE 'No' END AS flag_{code}" for code, test in FLAGS.items())
_CASES = " ".join(f"WHEN flag_{code} = 'Yes' THEN '{NAMES[code]}'" for code in FLAGS)


def _approval(stage: str, column: str) -> str:
    return (
        f"CASE {column} WHEN 'Pay' THEN '{stage}a' WHEN 'On Hold' THEN '{stage}b' WHEN 'Reject' THEN '{stage}c'"
        f" WHEN 'Not In Payment Sheet' THEN '{stage}d' END"
    )


_AMZ = "CASE WHEN wh_type = 'AMZ' THEN '{0}a' ELSE '{0}b' END"
_BLOCKER = """CASE WHEN batch_id IS NOT NULL AND split_part(current_status, '.', 1) IN ('19', '20', '21', '22')
  AND ffw_blocker <> 'Yes' THEN ffw_blocker ELSE 'No' END"""
_SUB = f"""CASE split_part(current_status, '.', 1)
  WHEN '01' THEN CASE final_status WHEN 'Pending Supervisor Approval' THEN '01a' WHEN 'Rejected By Supervisor' THEN '01b' END
  WHEN '02' THEN CASE WHEN supplier_vp_check = 'Not Available on VP' THEN '02a'
    WHEN supplier_confirmation_status = 'Pending Confirmation' THEN '02b' WHEN supplier_confirmation_status = 'Rejected' THEN '02c' END
  WHEN '05' THEN CASE pi_payment_status WHEN 'Pay' THEN '05a' WHEN 'On Hold' THEN '05b' WHEN 'Reject' THEN '05c' ELSE '05d' END
  WHEN '06' THEN CASE WHEN packaging_l2 IS NULL THEN '06b' END
  WHEN '07' THEN CASE WHEN transparency_pending = 'Missing' THEN '07a' ELSE '07b' END
  WHEN '09' THEN CASE WHEN prd <= planned_prd + INTERVAL 7 DAY THEN '09a' WHEN prd_delay_decision = 'SM Action Pending' THEN '09b'
    WHEN prd_delay_decision = 'IM Action Pending' THEN '09c' ELSE '09d' END
  WHEN '10' THEN CASE WHEN prd_reconfirmation = 'Yes' THEN '10b' ELSE '10a' END
  WHEN '11' THEN CASE WHEN compliance_status <> 'Approved' THEN '11a' ELSE '11b' END
  WHEN '13' THEN {_AMZ.format('13')}
  WHEN '16' THEN {_approval('16', 'batch_payment_approval')}
  WHEN '17' THEN CASE WHEN max_qc_state = 'Not Scheduled' THEN '17a' ELSE '17b' END
  WHEN '19' THEN CASE WHEN spd IS NOT NULL THEN '19b'
    WHEN l2_spd IN ('Not in SPD Sheet', 'No SPD Blocker Mentioned') THEN '19a' ELSE '19c' END
  WHEN '20' THEN CASE WHEN batch_qc_pending = 'Yes' THEN '20a' WHEN batch_incoterms = 'FOB' AND fob_date IS NULL THEN '20b' ELSE '20c' END
  WHEN '21' THEN CASE WHEN batch_incoterms IN ('DDP', 'DAP') OR CAST(fob_date AS DATE) < CAST({NOW} AS DATE) THEN '21a'
    WHEN CAST(fob_date AS DATE) < CAST({NOW} AS DATE) + 2 THEN '21b' ELSE '21c' END
  WHEN '22' THEN CASE WHEN actual_pickup_date IS NOT NULL THEN '22a' WHEN pickup_blocker <> 'No' THEN '22b' ELSE '22c' END
  WHEN '23' THEN CASE WHEN gate_in_date IS NULL THEN '23a' ELSE '23b' END
  WHEN '24' THEN CASE WHEN shipping_status = 'Not Shipped' THEN '24a' ELSE '24b' END
  WHEN '25' THEN CASE WHEN shipment_shipping_date > {NOW} - INTERVAL 5 DAY THEN '25a' ELSE '25b' END
  WHEN '26' THEN {_approval('26', 'inb_payment_approval')}
  WHEN '27' THEN {_approval('27', 'inb_payment_approval')}
  WHEN '28' THEN CASE WHEN actual_arrival_date IS NULL THEN
      CASE WHEN supplier_telex = 'Not Released' THEN '28a' WHEN sm_telex = 'Not Released' THEN '28b'
        WHEN ffw_telex = 'Not Released' THEN '28c' ELSE '28g' END
    WHEN supplier_telex = 'Not Released' THEN '28d' WHEN sm_telex = 'Not Released' THEN '28e'
    WHEN ffw_telex = 'Not Released' THEN '28f' ELSE '28g' END
  WHEN '29' THEN {_AMZ.format('29')} WHEN '30' THEN {_AMZ.format('30')} WHEN '31' THEN {_AMZ.format('31')} END"""


def _values(rows, names: str) -> str:
    def cell(value):
        return "NULL" if value is None else "'" + value + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows) + f") AS {names}"


# Fixed values, written out so that the SQL does not depend on the library under test.
SUB_STAGE_CODES = (
    "01a 01b 02a 02b 02c 05a 05b 05c 05d 06b 07a 07b 09a 09b 09c 09d 10a 10b 11a 11b 13a 13b 16a 16b 16c "
    "16d 17a 17b 19a 19b 19c 20a 20b 20c 21a 21b 21c 22a 22b 22c 23a 23b 24a 24b 25a 25b 26a 26b 26c 26d "
    "27a 27b 27c 27d 28a 28b 28c 28d 28e 28f 28g 29a 29b 30a 30b 31a 31b"
).split()
_ROLES = ("CM", "SM", "IM", "owner_1", "owner_2")


def _status_map() -> list[tuple]:
    """(code, text, accountable, responsible) as the check tables hold them."""
    texts = [(code, f"{code}. Sub stage {code}") for code in SUB_STAGE_CODES]
    texts += [(None, NAMES[code]) for code in ("a", "b", "c", "03", "08", "12", "15", "18")]
    texts += [(None, text) for text in ("04a. SM Review Pending", "14a. Documents Missing", "14b. SM Sign-Off Missing",
                                        "14c. FFW Sign-Off Missing", "06a. EAN Pending", "06b. SCM Check Pending")]
    return [(code, text, _ROLES[(at + 1) % 5], _ROLES[at % 5]) for at, (code, text) in enumerate(texts)]


def _blocker_map() -> list[tuple]:
    """(bucket, owner of the first listing, owner of the last listing)."""
    names = ["No Compliance Blocker Mentioned", "No PI Blocker Mentioned", "No PRD Blocker Mentioned", "No G2 Blocker Mentioned",
             "No QC Blocker Mentioned", "No SPD Blocker Mentioned", "No FFW Blocker Mentioned", "No Telex Blocker Mentioned",
             "No truck", "Compliance note", "PI note", "FFW note", "Supplier note", "Cargo Picked(SM)"]
    return [(name, ("owner_1", "SM", "CM", "owner_2")[at % 4], ("owner_3", "IM")[at % 2]) for at, name in enumerate(names)]


_TELEX_REMARKS = (
    """CASE WHEN sn % 5 <> 0 THEN CASE WHEN sn % 2 = 0 THEN 'No Telex Blocker Mentioned' ELSE 'Supplier note' END
       ELSE 'Not in Telex Sheet' END""",
    """CASE WHEN sn % 7 <> 0 THEN CASE WHEN sn % 2 = 0 THEN 'No FFW Telex Blocker Mentioned' ELSE 'FFW note' END
       ELSE 'Not in FFW Telex Sheet' END""",
)


def stage(grouped: str, remarks: tuple[str, str] = _TELEX_REMARKS) -> str:
    """Stage, sub-stage, blocker and owner, after the grouped lines ``l6``."""
    return grouped + f""",
l7 AS (SELECT *, {_FLAG_COLUMNS} FROM l6),
l8 AS (SELECT *, CASE WHEN flag_31 = 'Yes' THEN '{NAMES['31']}' {_CASES} END AS current_status FROM l7),
l9 AS (SELECT *, {_BLOCKER} AS pickup_blocker FROM l8),
l10 AS (SELECT *, {_SUB} AS sub_key FROM l9),
sm_ AS (SELECT * FROM {_values(_status_map(), 'm(code, text, accountable, responsible)')}),
l11 AS (
  SELECT l10.*, CASE split_part(current_status, '.', 1) WHEN '04' THEN vp_pi_status WHEN '14' THEN batch_sign_off
      WHEN '06' THEN coalesce(packaging_l2, m.text)
      WHEN 'A' THEN current_status WHEN 'B' THEN current_status WHEN 'C' THEN current_status WHEN '03' THEN current_status
      WHEN '08' THEN current_status WHEN '12' THEN current_status WHEN '15' THEN current_status WHEN '18' THEN current_status
      ELSE m.text END AS sub_status
  FROM l10 LEFT JOIN sm_ m ON sub_key = m.code),
l12 AS (
  SELECT *, nullif(split_part(current_status, '.', 1), '') AS status_code,
    nullif(regexp_extract(sub_status, '^(\\d+[a-z]?)', 1), '') AS sub_code FROM l11),
l13 AS (
  SELECT *, CASE WHEN sub_code IN ('28a', '28b', '28d', '28e') THEN {remarks[0]} ELSE {remarks[1]} END AS l2_telex FROM l12),
l14 AS (
  SELECT *, CASE WHEN pickup_blocker <> 'No' THEN pickup_blocker
    WHEN status_code = 'B' OR sub_code = '11a' THEN l2_compliance
    WHEN status_code IN ('03', '04') OR sub_code IN ('03', '04') THEN l2_pi
    WHEN status_code = '08' OR sub_code = '08' THEN l2_prd
    WHEN sub_code = '10a' THEN l2_cprd
    WHEN status_code = '12' OR sub_code = '12' THEN l2_g2
    WHEN sub_code IN ('14a', '14b') THEN l2_g4
    WHEN status_code = '17' OR sub_code IN ('17', '20a') THEN l2_qc
    WHEN sub_code IN ('19a', '19c') THEN l2_spd
    WHEN status_code IN ('18', '22', '23', '24') OR sub_code IN ('14c', '20b', '18', '22', '23', '24') THEN l2_pickup
    WHEN status_code IN ('29', '30', '31') OR sub_code IN ('28a', '28b', '28c', '28d', '28e', '28f', '29', '30', '31') THEN l2_telex
    WHEN status_code IN ('20', '21', '22') AND production_status = 'Cargo Picked(SM)' THEN 'Cargo Picked(SM)'
    ELSE 'No L2 Status' END AS l2_final_status FROM l13),
l15 AS (
  SELECT l14.*, coalesce(m.accountable, '') AS accountable, coalesce(m.responsible, '') AS responsible,
    CASE WHEN pickup_blocker <> 'No' THEN coalesce(owner_last, 'owner_9')
      WHEN l2_final_status <> 'No L2 Status' THEN coalesce(owner_first, 'owner_9')
      ELSE coalesce(m.responsible, '') END AS final_responsibility
  FROM l14 LEFT JOIN sm_ m ON sub_status = m.text
  LEFT JOIN {_values(_blocker_map(), 'bl(bucket, owner_first, owner_last)')} ON l2_final_status = bucket),
l16 AS (
  SELECT *, CASE final_responsibility WHEN 'CM' THEN cm WHEN 'SM' THEN sm WHEN 'IM' THEN 'owner_8' ELSE final_responsibility END AS final_poc,
    CASE WHEN length(final_responsibility) = 2 THEN final_responsibility WHEN final_responsibility = 'owner_1' THEN 'Payment'
      WHEN final_responsibility = 'owner_2' THEN 'QC' WHEN final_responsibility = 'owner_3' THEN 'Packaging'
      ELSE 'Central Team' END AS final_team,
    coalesce('R' || upper(split_part(current_status, '.', 1)), '') AS reporting_status FROM l15)"""


STAGE = stage(GROUPS)

PUBLISHED = """id, associated_brands AS scm_associated_brands, incoterms, quantity_on_shipments, sm_line_signoff, date_created, document_number, po_vendor, supplier_confirmation_status, final_status,
  memo AS scm_po_scm_memo, marketplace AS marketplace_header, supplier_payment_terms, line_id, item, asin, quantity,
  quantity_received AS "quantity_fulfilled/received", first_prd, prd, planned_prd, confirmed_crd, quality_control_date,
  quality_control_status, im_line_signoff, production_status, batch_id, wh_type, considered_anti_po AS "considered_for_anti-po",
  prd_reconfirmation, invoice_number, invoice_status, placement_batch AS "Placement Batch", focus AS "OTIF Focus", mp AS "MP",
  item_rate_eur, CAST(pending_units AS DOUBLE) AS "Pending Units", pending_value AS "Pending Value", line_key AS po_razin_id,
  line_payment_type AS "Line Payment Type", batch_payment_type AS "Batch Payment Type", inb_payment_type AS "INB Payment Type",
  line_invoice_submission AS "Line Invoice Submission Status", batch_invoice_submission AS "Batch Invoice Submission Status",
  inb_invoice_submission AS "INB Invoice Submission Status", line_payment_status AS "Line Payment Status",
  batch_payment_status AS "Batch Payment Status", inb_payment_status AS "INB Payment Status",
  batch_qc_pending AS "Batch QC Pending", vp_booking_status AS "VP Booking Status", fob_date AS "FOB Date",
  batch_pickup_status AS "Batch Pickup Status", shipping_status AS "Shipping Status", shipment_number AS "INB#",
  shipment_status AS "Status", substatus AS "Substatus", estimated_delivery_date AS "Estimated OTIF Delivery Date",
  supplier_telex AS "Supplier Telex Status", sm_telex AS "SM Telex Status", ffw_telex AS "FFW Telex Status", cm AS "CM", sm AS "SM",
  compliance_status AS "Compliance Status", current_status AS "Current Status", sub_status AS "Sub Status",
  '' AS "Days Bucket", team AS "Team", reporting_status AS "Reporting Status", l2_final_status AS "L2 Final Status",
  final_poc AS "Final POC", final_team AS "Final Team" """


def _from(ctes: str, columns: str, last: str) -> str:
    return f"WITH {ctes} SELECT {columns} FROM {last}"


def _full() -> str:
    """All shown columns: those not in ``l16`` are written out, the others are taken as they are."""
    own = {
        "article_key": "document_number || item", "article_market": "item || marketplace", "asin_market": "asin || marketplace",
        "pending_units": "CAST(pending_units AS DOUBLE)", "days": "''", "days_bucket": "''", "flag_d": "flag_d", "sub_d": "'NA'",
        **{name: "NULL" for name in ("subsidiary", "quantity_billed", "item_rate", "currency", "amount_foreign_currency", "prd_change_reason",
                                     "historical_anti_po")},
        **{f"sub_{code}": f"CASE WHEN lower(status_code) = '{code}' THEN sub_status ELSE 'NA' END" for code in FLAGS},
    }
    columns = ", ".join(f'{own.get(inside, inside)} AS "{shown}"' for inside, shown in full_columns().items())
    return _from(STAGE, columns, "l16")


_LATE = f"""SELECT line_key, status_code, CASE WHEN TRY_CAST(status_code AS INTEGER) IS NOT NULL
    THEN CASE WHEN shipped IS NOT NULL THEN CAST(floor((epoch_us(shipped) - epoch_us(made)) / 86400000000.0) AS BIGINT)
      WHEN {NOW} > made THEN CAST(floor((epoch_us({NOW}) - epoch_us(made)) / 86400000000.0) AS BIGINT) END END AS days
  FROM l12 LEFT JOIN (SELECT document_number || item || line_id AS line_key, CAST(min(l_shipdate) AS TIMESTAMP) AS made,
      CASE WHEN min(k) % 3 <> 0 THEN CAST(max(l_shipdate) AS TIMESTAMP) END AS shipped FROM lg GROUP BY document_number, item, line_id) USING (line_key)"""

ORACLE = {
    "full_report": _full(),
    "late_days": f"WITH {STAGE} {_LATE}",
    "open_lines": _from(BASE, "line_key, final_status, memo, quantity, quantity_received", """po
        WHERE final_status NOT IN ('Closed', 'Legacy Closed', 'Fully Billed') AND quantity - quantity_received > 0
          AND (memo IS NULL OR memo <> 'import_ic_flow')"""),
    "pending_units": _from(LINES, "line_key, pending_units, pending_value", "l1"),
    "prd_decision": _from(LINES, "line_key, prd_delay_decision", "l1"),
    "payment_types": _from(
        LINES, "line_key, pi, ci, bl, bl_days, line_payment_type, line_invoice_submission, line_payment_status", "l1"),
    "group_payments": _from(GROUPS, "line_key, batch_payment_type, batch_invoice_submission, batch_payment_status,"
                            " batch_payment_approval, inb_payment_type, inb_invoice_submission, inb_payment_status,"
                            " inb_payment_approval", "l6"),
    "lookup_instances": _from(
        LOOKUPS, "line_key, expected_arrival_date, fob_status, spd_delay_reason, transparency_pending", "l2"),
    "qc_status": _from(GROUPS, "line_key, qc_stage, qc_pending, batch_qc_pending, max_qc_date, max_qc_state", "l6"),
    "pickup_status": _from(GROUPS, "line_key, batch_pickup_status, vp_booking_status, shipping_status", "l6"),
    "estimated_delivery": _from(GROUPS, "line_key, estimated_delivery_date", "l6"),
    "telex_cascade": _from(GROUPS, "line_key, shipment_number, supplier_telex, sm_telex, ffw_telex", "l6"),
    "team_priority": _from(GROUPS, "line_key, team, focus", "l6"),
    "batch_compliance": _from(GROUPS, "line_key, compliance_status, batch_compliance", "l6"),
    "master_blocker": _from(GROUPS, "line_key, md_blocker, flag_d", "l6"),
    "booking_rule": """SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'Not Booked' WHEN o_orderkey % 5 IN (3, 4)
        THEN 'Booked' WHEN o_orderkey % 3 <> 0 THEN 'Booked' ELSE 'Not Booked' END AS booking FROM orders""",
    "stage_flags": _from(STAGE, "line_key, " + ", ".join(f"flag_{code}" for code in FLAGS), "l7"),
    "current_stage": _from(STAGE, "line_key, current_status, status_code", "l12"),
    "sub_stage": _from(STAGE, "line_key, current_status, sub_status, sub_code", "l12"),
    "sub_stage_columns": _from(STAGE, "line_key, " + ", ".join(
        f"CASE WHEN lower(status_code) = '{code}' THEN sub_status ELSE 'NA' END AS sub_{code}" for code in FLAGS), "l12"),
    "blocker_owner": _from(STAGE, "line_key, pickup_blocker, l2_telex, l2_final_status, accountable, responsible,"
                           " final_responsibility, final_poc, final_team", "l16"),
    "status_report": _from(STAGE, PUBLISHED, "l16"),
}
