"""SQL for the stage timeline, written from the rules.

Stages are listed with their SQL by hand; the rule itself is one text applied stage by stage.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2001-01-01 00:00:00'"

DATES = (
    "po_approval_date", "supplier_confirmation_date", "pi_invoice_approval_date", "pi_payment_date",
    "receive_first_prd_date", "prd_reconfirmed_date", "po_im_date_value", "po_sm_date_value",
    "batch_created_ts", "sm_signoff_ts", "ci_invoice_approval_date", "ci_payment_date",
    "qc_schedule_date", "ffw_booking_ts", "spd_ts", "stock_pickup_date", "shipment_creation_date",
    "shipment_in_transit_date", "bi_invoice_approval_date", "bi_payment_date",
    "ffwp_telex_release_date", "shipment_stock_delivery_date", "item_receipt_date",
    "actual_cargo_pick_up_date", "actual_shipping_date", "actual_arrival_date", "actual_delivery_date",
)


def _base() -> str:
    dates = ",\n".join(
        f"CASE WHEN {k} <= h % 33 AND (h + {k * 11}) % 9 <> 0 THEN po_created_date"
        f" + to_hours(({k * 4 - 3} + (h * {k}) % 13) * 24 + (h + {k}) % 24) END AS {name}"
        for k, name in enumerate(DATES, start=1)
    )
    return f"""
base AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS po_id,
    l_orderkey * 7 + l_partkey * 13 + l_suppkey * 3 + l_linenumber * 5 AS h,
    coalesce(o_orderdate, l_shipdate - INTERVAL 90 DAY) AS po_created_date
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
po AS (
  SELECT po_id, po_created_date, {dates},
    CASE WHEN h % 4 = 0 THEN NULL WHEN h % 4 < 3 THEN 1 ELSE 0 END AS pi_applicable,
    CASE WHEN h % 3 = 0 THEN 1 ELSE 0 END AS ci_applicable,
    CASE WHEN h % 5 <> 0 THEN CAST(h % 30 + 20 AS INTEGER) END AS plt
  FROM base)"""


def days(column: str, n: int) -> str:
    return f"({column} + INTERVAL {n} DAY)"


# id: (predecessor date, actual, fallback, lead time, team, on the critical path, name)
SMALL = {
    1: ("NULL", "receive_first_prd_date", "po_created_date", 4, "Desk", True, "Ready date known"),
    2: ("d1", "sm_signoff_ts", "NULL", 1, "Desk", True, "Goods released"),
    3: ("CASE WHEN ci_applicable = 0 THEN d1 END", "qc_schedule_date",
        f"greatest(batch_created_ts, {days('po_sm_date_value', 6)})", 2, "Lab", False, "Inspection"),
    4: ("CASE WHEN pi_applicable IS DISTINCT FROM 1 THEN greatest(d3, d2) ELSE d1 END", "ffw_booking_ts", "NULL", 7,
        "Freight", True, "Space booked"),
    5: ("greatest(d3, d4)", "actual_shipping_date", days("d3", 9), 0, "Freight", True, "Departure"),
    6: ("NULL", "NULL", "greatest(item_receipt_date, d5 + to_days(plt - 8))", 3, "Dock", True, "Stock in"),
}
_CI, _PI = "ci_applicable = 1", "CASE WHEN pi_applicable = 1 THEN d5 ELSE d2 END"


def _later(column: str, other: str, n: int) -> str:
    return f"greatest({column}, {days(other, n)})"


FULL = {
    1: ("NULL", "po_approval_date", "po_created_date", 2, "Procurement", True, "01. PO Approval Pending"),
    2: ("d1", "supplier_confirmation_date", "NULL", 3, "Procurement", True, "02. Supplier Confirmation Pending"),
    3: ("d2", "pi_invoice_approval_date", "NULL", 1, "Procurement", True, "03. PI Upload Pending"),
    4: ("d3", "pi_invoice_approval_date", _later("supplier_confirmation_date", "po_approval_date", 5), 2,
        "Finance", True, "04. PI Approval Pending"),
    5: ("d4", "pi_payment_date", _later("pi_invoice_approval_date", "supplier_confirmation_date", 2), 5,
        "Finance", True, "05. PI Payment Pending"),
    6: (_PI, "NULL", _later("pi_payment_date", "pi_invoice_approval_date", 5), 3, "Operations", False,
        "06. Packaging Pending"),
    7: (_PI, "NULL", _later("pi_payment_date", "pi_invoice_approval_date", 5), 2, "Operations", False,
        "07. Transparency Label Pending"),
    8: (_PI, "receive_first_prd_date", _later("receive_first_prd_date", "pi_payment_date", 2), 2, "Finance",
        False, "08. PRD Pending"),
    9: ("d8", "NULL", f"greatest(receive_first_prd_date, {days('pi_payment_date', 2)}, "
        f"{days('supplier_confirmation_date', 3)})", 7, "Supplier", True, "09. Under Production"),
    10: ("NULL", "prd_reconfirmed_date", "greatest(prd_reconfirmed_date, receive_first_prd_date + to_days(plt - 21),"
         " d8 + to_days(plt) - INTERVAL 21 DAY)", 1, "Procurement", True, "10. PRD Confirmation Pending"),
    11: ("d10", "po_im_date_value", _later("po_im_date_value", "prd_reconfirmed_date", 1), 2, "Operations", True,
         "11. IM Sign-Off Pending"),
    12: ("d11", "po_sm_date_value", _later("po_im_date_value", "prd_reconfirmed_date", 2), 1, "Operations", True,
         "12. Ready for Batching Pending"),
    13: ("d12", "batch_created_ts", _later("po_sm_date_value", "po_im_date_value", 2), 1, "Operations", True,
         "13. Batch Creation Pending"),
    14: ("d13", "sm_signoff_ts", _later("batch_created_ts", "po_sm_date_value", 1), 2, "Operations", True,
         "14. SM Sign-Off Pending"),
    15: (f"CASE WHEN {_CI} THEN d14 END", "ci_invoice_approval_date", "NULL", 1, "Finance", True,
         "15. CI Approval Pending"),
    16: ("d15", "ci_payment_date", "NULL", 3, "Finance", True, "16. CI Payment Pending"),
    17: (f"CASE WHEN {_CI} THEN d16 ELSE d14 END", "qc_schedule_date", "NULL", 2, "Quality", True,
         "17. QC Schedule Pending"),
    18: (f"CASE WHEN {_CI} THEN greatest(d14, d16, d17) ELSE d17 END", "ffw_booking_ts",
         _later("ffw_booking_ts", "qc_schedule_date", 2), 1, "Logistics", True, "18. FFW Booking Missing"),
    19: ("d18", "spd_ts", _later("spd_ts", "ffw_booking_ts", 1), 3, "Logistics", True,
         "19. Supplier Pickup Date Pending"),
    20: ("d19", "stock_pickup_date", "NULL", 1, "Quality", True, "20. Pre Pickup Check"),
    21: ("d20", "actual_cargo_pick_up_date", _later("actual_cargo_pick_up_date", "stock_pickup_date", 1), 2,
         "Logistics", True, "21. FOB Pickup Pending"),
    22: ("d20", "actual_cargo_pick_up_date", _later("actual_cargo_pick_up_date", "stock_pickup_date", 1), 2,
         "Logistics", False, "22. Non FOB Pickup Pending"),
    23: ("d21", "shipment_creation_date", _later("shipment_creation_date", "actual_cargo_pick_up_date", 2), 1,
         "Logistics", True, "23. INB Creation Pending"),
    24: ("d23", "shipment_in_transit_date", _later("shipment_in_transit_date", "shipment_creation_date", 1), 3,
         "Logistics", True, "24. Mark In-Transit Pending"),
    25: ("d24", "bi_invoice_approval_date", _later("bi_invoice_approval_date", "shipment_in_transit_date", 3), 1,
         "Finance", True, "25. BL Approval Pending"),
    26: ("d25", "bi_payment_date", _later("bi_payment_date", "bi_invoice_approval_date", 1), 5, "Finance", True,
         "26. BL Payment Pending - In Transit"),
    27: ("d25", "actual_arrival_date", _later("bi_payment_date", "actual_arrival_date", 1), 3, "Finance", False,
         "27. BL Payment Pending - Arrived"),
    28: ("greatest(d26, d27)", "ffwp_telex_release_date", _later("ffwp_telex_release_date", "bi_payment_date", 3), 1,
         "Finance", True, "28. Telex Release Pending"),
    29: ("d28", "shipment_stock_delivery_date",
         _later("shipment_stock_delivery_date", "ffwp_telex_release_date", 1), 2, "Logistics", True,
         "29. Stock Delivery Pending"),
    30: ("d29", "item_receipt_date", _later("item_receipt_date", "shipment_stock_delivery_date", 2), 1, "Warehouse",
         True, "30. Stock Receiving Pending"),
    31: ("d30", "NULL", _later("actual_delivery_date", "item_receipt_date", 1), 2, "Finance", True,
         "31. Dispute - PO Closing Pending"),
}

# Stage date and method under each reading of the rules; {p}, {a}, {f} are the predecessor,
# actual and fallback dates, {due} the predecessor date plus lead time.
RULES = {
    "modular": (
        """CASE WHEN {p} IS NOT NULL AND {a} IS NOT NULL THEN CASE WHEN {a} >= {p} THEN {a} ELSE {due} END
             WHEN {p} IS NOT NULL THEN {due} WHEN {f} IS NULL THEN NULL ELSE {a} END""",
        """CASE WHEN {p} IS NOT NULL AND {a} IS NOT NULL
               THEN CASE WHEN {a} >= {p} THEN 'actual_over_precedence' ELSE 'precedence_over_actual' END
             WHEN {p} IS NOT NULL THEN 'precedence_only' WHEN {f} IS NULL THEN 'failed'
             WHEN {a} IS NOT NULL THEN 'actual_only' ELSE 'fallback' END""",
        "CASE WHEN {p} IS NOT NULL THEN {due} ELSE {f} END",
    ),
    "legacy": (
        """CASE WHEN {p} IS NOT NULL AND {a} IS NOT NULL THEN CASE WHEN {a} >= {p} THEN {a} ELSE {p} END
             WHEN {a} IS NOT NULL THEN {a} WHEN {p} IS NOT NULL THEN {due} END""",
        """CASE WHEN {p} IS NOT NULL AND {a} IS NOT NULL
               THEN CASE WHEN {a} >= {p} THEN 'actual_over_precedence' ELSE 'precedence_over_actual' END
             WHEN {a} IS NOT NULL THEN 'actual_only' WHEN {p} IS NOT NULL THEN 'precedence_only'
             WHEN {f} IS NULL THEN 'failed' END""",
        "CASE WHEN {p} IS NOT NULL THEN {due} ELSE {f} END",
    ),
    "notebook": (
        """CASE WHEN {p} IS NOT NULL AND {a} IS NOT NULL THEN CASE WHEN {a} >= {due} THEN {a} ELSE {due} END
             WHEN {a} IS NOT NULL THEN {a} WHEN {p} IS NOT NULL THEN {due}
             ELSE {f} + INTERVAL {lead} DAY END""",
        """CASE WHEN {p} IS NOT NULL AND {a} IS NOT NULL
               THEN CASE WHEN {a} >= {due} THEN 'actual_over_precedence' ELSE 'precedence_over_actual' END
             WHEN {a} IS NOT NULL THEN 'actual_only' WHEN {p} IS NOT NULL THEN 'precedence_only'
             WHEN {f} IS NOT NULL THEN 'fallback' ELSE 'failed' END""",
        "NULL",
    ),
}


def chain(stages: dict, variant: str = "modular") -> str:
    """WITH clause ending in ``tl``: d, m, t, p, a columns per stage."""
    date, method, target = RULES[variant]
    ctes, prev = [_base()], "po"
    for k, (reached, actual, fallback, lead, *_rest) in stages.items():
        p, a, f = f"p{k}", f"a{k}", f"f{k}"
        ctes.append(
            f"q{k} AS (SELECT *, CAST({reached} AS TIMESTAMP) AS {p}, CAST({actual} AS TIMESTAMP) AS {a},"
            f" CAST({fallback} AS TIMESTAMP) AS {f} FROM {prev})"
        )
        names = {"p": p, "a": a, "f": f, "due": days(p, lead), "lead": lead}
        ctes.append(
            f"s{k} AS (SELECT *, {date.format(**names)} AS d{k}, {method.format(**names)} AS m{k},"
            f" {target.format(**names)} AS t{k} FROM q{k})"
        )
        prev = f"s{k}"
    ctes.append(f"tl AS MATERIALIZED (SELECT * FROM {prev})")
    return "WITH " + ",\n".join(ctes)


def whole_days(a: str, b: str) -> str:
    return f"CAST(floor((epoch_us({a}) - epoch_us({b})) / 86400000000.0) AS BIGINT)"


def delayed(stages: dict, mode: str = "report") -> str:
    """Adds x (days) and y (status) per stage; ends in ``dl``."""
    columns = []
    for k, (_, actual, *_rest) in stages.items():
        target = f"coalesce(t{k}, d{k})"
        if actual == "NULL" and mode == "integrated":
            columns.append(f"CAST(NULL AS BIGINT) AS x{k}, 'unknown' AS y{k}")
            continue
        done = whole_days(f"a{k}", target)
        columns.append(
            f"CASE WHEN a{k} IS NOT NULL THEN {done} WHEN {AS_OF} > {target} THEN {whole_days(AS_OF, target)} END AS x{k},"
            f" CASE WHEN {target} IS NULL THEN 'unknown' WHEN a{k} IS NULL AND {AS_OF} > {target} THEN 'pending_overdue'"
            f" WHEN a{k} IS NULL THEN 'pending' WHEN {done} > 0 THEN 'delayed' WHEN {done} < 0 THEN 'early'"
            f" ELSE 'on_time' END AS y{k}"
        )
    return f"{chain(stages)}, dl AS MATERIALIZED (SELECT *, {', '.join(columns)} FROM tl)"


def _sum(parts) -> str:
    return "CAST(" + " + ".join(parts) + " AS BIGINT)"


def _count(tests) -> str:
    return _sum(f"(CASE WHEN {test} THEN 1 ELSE 0 END)" for test in tests)


def _average(total: str, count: str) -> str:
    return f"CASE WHEN {count} > 0 THEN round_even({total} / {count}, 2) ELSE CAST(0 AS DOUBLE) END"


def _wide(stages: dict, pattern: str) -> str:
    return ", ".join(pattern.format(k=k, name=stages[k][6]) for k in stages)


def _figures(stages: dict) -> str:
    late = "y{k} IN ('delayed', 'pending_overdue')"
    total = _sum(f"(CASE WHEN {late.format(k=k)} THEN x{k} ELSE 0 END)" for k in stages)
    only = _sum(f"(CASE WHEN y{k} = 'delayed' THEN x{k} ELSE 0 END)" for k in stages)
    counts = ", ".join(
        _count(f"y{k} = '{status}'" for k in stages) + f" AS {status}_stages"
        for status in ("delayed", "early", "on_time", "pending", "pending_overdue")
    )
    critical = _count(late.format(k=k) for k in stages if stages[k][5])
    return (
        f"fig AS (SELECT po_id, CAST({len(stages)} AS BIGINT) AS total_stages, {counts}, {total} AS total_delay_days,"
        f" {only} AS delayed_only_days, {critical} AS critical_path_delays FROM dl)"
    )


def _teams(stages: dict) -> str:
    names = list(dict.fromkeys(stages[k][4] for k in stages))
    rows = []
    for team in names:
        owned = [k for k in stages if stages[k][4] == team]
        first = "CASE " + " ".join(f"WHEN x{k} IS NOT NULL THEN {k}" for k in owned) + " END"
        rows.append(
            f"SELECT po_id, '{team}' AS team, {_count(f'x{k} IS NOT NULL' for k in owned)} AS total_stages,"
            f" {_count(f'x{k} > 0' for k in owned)} AS delayed_stages,"
            f" {_sum(f'(CASE WHEN x{k} > 0 THEN x{k} ELSE 0 END)' for k in owned)} AS total_delay_days,"
            f" {first} AS first_stage FROM dl"
        )
    return (
        "tm0 AS (" + " UNION ALL ".join(rows) + "), tm AS (SELECT *, "
        + _average("total_delay_days", "delayed_stages") + " AS average_delay_days FROM tm0 WHERE total_stages > 0)"
    )


_WORST = """worst AS (SELECT po_id, team, average_delay_days FROM tm WHERE average_delay_days > 0
  QUALIFY row_number() OVER (PARTITION BY po_id ORDER BY average_delay_days DESC, first_stage) = 1)"""


def _variant_sql(variant: str) -> str:
    pattern = "d{k} AS date_{k}, m{k} AS method_{k}"
    if variant != "notebook":
        pattern += ", t{k} AS target_{k}, p{k} AS reached_{k}"
    return f"{chain(SMALL, variant)} SELECT po_id, {_wide(SMALL, pattern)} FROM tl"


def _long(stages: dict, select: str, source: str) -> str:
    return " UNION ALL ".join("SELECT po_id, " + select.format(k=k) + f" FROM {source}" for k in stages)


def _reason(k) -> str:
    return (
        f"CASE y{k} WHEN 'delayed' THEN 'Actual completion ' || x{k} || ' days after target'"
        f" WHEN 'early' THEN 'Completed ' || abs(x{k}) || ' days before target'"
        f" WHEN 'on_time' THEN 'Completed on target date'"
        f" WHEN 'pending_overdue' THEN 'Stage incomplete, ' || x{k} || ' days overdue'"
        f" WHEN 'pending' THEN 'Stage not yet completed' END"
    )


def _delay_rows() -> str:
    rows = " UNION ALL ".join(
        f"SELECT po_id, '{k}' AS stage_id, coalesce(t{k}, d{k}) AS target_timestamp, a{k} AS actual_date,"
        f" x{k} AS delay_days, y{k} AS delay_status, {_reason(k)} AS delay_reason,"
        f" CASE WHEN x{k} IS NOT NULL THEN '{SMALL[k][4]}' END AS team_responsible FROM dl"
        for k in SMALL
    )
    return f"{delayed(SMALL)} {rows}"


def _dependency_rows() -> str:
    both, one = "pi_applicable IS DISTINCT FROM 1", "pi_applicable IS NOT DISTINCT FROM 1"
    used = {1: [], 2: [(1, "TRUE")], 3: [(1, "ci_applicable = 0")], 4: [(3, both), (2, both), (1, one)],
            5: [(3, "TRUE"), (4, "TRUE")], 6: []}
    formula = {1: "po_created_date", 3: "max(batch_created_ts, add_days(po_sm_date_value, 6))",
               5: "stage_3 + 9", 6: "max(item_receipt_date, stage_5 + plt - 8)"}
    rows = []
    for k, (_, actual, _f, lead, *_rest) in SMALL.items():
        listed = ", ".join(
            f"CASE WHEN {test} AND d{n} IS NOT NULL THEN '{n}@{SMALL[n][6]}@' || strftime(d{n}, '%Y-%m-%d %H:%M')"
            f" || '@' || m{n} END" for n, test in used[k]
        )
        deps = f"concat_ws(';', {listed})" if listed else "''"
        fallback = f"'{formula[k]}'" if k in formula else "NULL"
        day = "strftime({}, '%Y-%m-%d')"
        rows.append(f"""SELECT po_id, '{k}' AS stage_id,
          CASE WHEN m{k} IN ('actual_only', 'actual_over_precedence')
                 THEN 'Calculation: {actual} = ' || strftime(a{k}, '%Y-%m-%d %H:%M:%S')
               WHEN m{k} = 'precedence_over_actual' THEN 'Calculated from dependencies'
               WHEN m{k} = 'precedence_only' THEN 'Calculated from dependencies + {lead} days'
               WHEN m{k} = 'fallback' THEN {fallback} END AS source,
          CASE m{k} WHEN 'actual_only' THEN 'Using actual timestamp'
               WHEN 'precedence_only' THEN 'No actual timestamp available, using precedence calculation'
               WHEN 'actual_over_precedence' THEN 'Actual date (' || {day.format(f'a{k}')}
                 || ') is later than precedence date (' || {day.format(f'p{k}')} || ')'
               WHEN 'precedence_over_actual' THEN 'Precedence stage''s timestamp (' || {day.format(f'p{k}')}
                 || ') is later than actual (' || {day.format(f'a{k}')} || ')'
               WHEN 'fallback' THEN 'No precedence available, using fallback expression'
               ELSE 'No valid calculation method available' END AS decision,
          CASE m{k} WHEN 'actual_only' THEN 'No dependency chain available'
               WHEN 'precedence_only' THEN 'No actual timestamp available'
               WHEN 'actual_over_precedence' THEN 'Actual timestamp is later than calculated precedence'
               WHEN 'precedence_over_actual' THEN 'Calculated precedence is later than actual timestamp'
               WHEN 'fallback' THEN 'Using fallback calculation' END AS reason,
          {deps} AS dependencies FROM tl""")
    return f"{chain(SMALL)} " + " UNION ALL ".join(rows)


_READY = "CASE WHEN plt IS NULL OR plt NOT IN (41, 42) THEN receive_first_prd_date END"
FAILING = {
    1: ("NULL", _READY, "po_created_date", 1, "", False, "Ready"),
    2: ("CASE WHEN plt > 30 THEN d1 END", "qc_schedule_date", f"greatest(batch_created_ts, {_READY})", 2, "", False, "Checked"),
    3: ("CASE WHEN d2 >= po_created_date THEN d2 ELSE d1 END", "spd_ts", "NULL", 0, "", False, "Sent"),
}


def _failures() -> str:
    errors = (
        (1, "actual", "receive_first_prd_date is no date", "plt = 41"), (2, "preceding", "plt > 30: a side is missing", "plt IS NULL"),
        (2, "fallback", "receive_first_prd_date is no date", "plt = 41"),
        (3, "preceding", "stage_2 >= po_created_date: a side is missing", "d2 IS NULL"),
    )
    rows = [
        f"SELECT po_id, '{k}' AS stage_id, '{part}' AS part, '{error}' AS error, {part == 'preceding'} AS fatal FROM tl WHERE {test}"
        for k, part, error, test in errors
    ]
    rows.append("""SELECT po_id, '3' AS stage_id, 'date' AS part, strftime(d3, '%Y-%m-%d %H:%M') AS error, FALSE AS fatal FROM tl
        WHERE plt IS NOT NULL AND d2 IS NOT NULL""")
    return f"{chain(FAILING)} " + " UNION ALL ".join(rows)


def _documents() -> str:
    both, one = "pi_applicable IS DISTINCT FROM 1", "pi_applicable IS NOT DISTINCT FROM 1"
    used = {1: [], 2: [(1, "TRUE")], 3: [(1, "ci_applicable = 0")], 4: [(3, both), (2, both), (1, one)],
            5: [(3, "TRUE"), (4, "TRUE")], 6: []}
    rows = []
    for k, (_, _a, _f, lead, team, _critical, name) in SMALL.items():
        listed = ", ".join(
            f"CASE WHEN {test} AND d{n} IS NOT NULL THEN '{n}@' || strftime(d{n}, '%Y-%m-%d %H:%M') END" for n, test in used[k])
        needs = f"concat_ws(';', {listed})" if listed else "''"
        rows.append(
            f"SELECT po_id, '{k}' AS stage_id, '{name}' AS stage_name, d{k} AS date, m{k} AS method, {lead} AS lead_time_days, '{team}' AS team_owner,"
            f" x{k} AS delay_days, y{k} AS delay_status, {needs} AS needs, calculated_stages, delayed_stages, total_delay_days FROM dl JOIN sums USING (po_id)")
    sums = "SELECT po_id, " + ", ".join((
        " + ".join(f"(d{k} IS NOT NULL)::BIGINT" for k in SMALL) + " AS calculated_stages",
        " + ".join(f"(y{k} = 'delayed')::BIGINT" for k in SMALL) + " AS delayed_stages",
        " + ".join(f"CASE WHEN y{k} IN ('delayed', 'pending_overdue') THEN x{k} ELSE 0 END" for k in SMALL) + " AS total_delay_days"))
    return f"{delayed(SMALL)}, sums AS ({sums} FROM dl) " + " UNION ALL ".join(rows)


def _metadata() -> str:
    facts = {1: ("planning", ""), 2: ("release", ""), 3: ("check", "2"), 4: ("booking", "2,3"),
             5: ("transport", ""), 6: ("storing", "")}
    rows = " UNION ALL ".join(
        f"SELECT po_id, '{k}' AS stage_id, '{SMALL[k][6]}' AS stage_name, d{k} AS date, '{SMALL[k][4]}' AS team_owner,"
        f" '{facts[k][0]}' AS process_type, {str(SMALL[k][5]).upper()} AS critical_path,"
        f" {SMALL[k][3]} AS lead_time, '{facts[k][1]}' AS parallel_processes, 0 AS handoff_points FROM tl"
        for k in SMALL
    )
    return f"{chain(SMALL)} {rows}"


def _global() -> str:
    late = " UNION ALL ".join(
        f"SELECT po_id, x{k} AS days, {k} AS pos, '{FULL[k][6]}' AS stage FROM dl WHERE x{k} > 0" for k in FULL
    )
    return f"""{delayed(FULL)}, {_figures(FULL)},
      top AS (SELECT * FROM ({late}) ORDER BY days DESC, po_id, pos LIMIT 1)
      SELECT CAST(sum(delayed_stages) AS BIGINT) AS delayed_stages, CAST(sum(early_stages) AS BIGINT) AS early_stages,
        CAST(sum(on_time_stages) AS BIGINT) AS on_time_stages,
        CAST(sum(pending_overdue_stages) AS BIGINT) AS pending_overdue_stages,
        coalesce((SELECT days FROM top), 0) AS max_delay_days, (SELECT po_id FROM top) AS worst_po,
        (SELECT stage FROM top) AS worst_stage FROM fig"""


def _insights() -> str:
    return f"""{delayed(FULL)}, {_figures(FULL)}, {_teams(FULL)}, {_WORST}
      SELECT fig.po_id, concat_ws(' | ',
        CASE WHEN delayed_stages = 0 THEN '✅ Excellent performance: No delays detected across all stages'
             WHEN delayed_stages / total_stages > 0.5 THEN '⚠️ Critical: ' || delayed_stages || ' out of '
               || total_stages || ' stages are delayed' END,
        CASE WHEN critical_path_delays > 0 THEN '🚨 ' || critical_path_delays
               || ' critical path stages are delayed, directly impacting delivery timeline' END,
        CASE WHEN average_delay_days > 5 THEN '📊 ' || team || ' team has highest average delay of '
               || average_delay_days || ' days' END,
        CASE WHEN pending_overdue_stages > 0 THEN '⏰ ' || pending_overdue_stages
               || ' stages are overdue and need immediate attention' END) AS insights
      FROM fig LEFT JOIN worst ON fig.po_id = worst.po_id"""


def _method_counts() -> str:
    counted = _count(f"d{k} IS NOT NULL" for k in FULL)
    methods = ", ".join(
        _count(f"m{k} = '{method}'" for k in FULL) + f" AS {method}"
        for method in ("actual_only", "precedence_only", "actual_over_precedence", "precedence_over_actual",
                       "fallback", "failed")
    )
    return (
        f"{chain(FULL)} SELECT po_id, CAST(31 AS BIGINT) AS total_stages, {counted} AS calculated_stages, {methods},"
        f" round_even({counted} / CAST(31 AS DOUBLE) * 100, 2) AS completion_rate FROM tl"
    )


def _null_profile() -> str:
    names = ("po_created_date", *DATES)
    rows = " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER ({name} IS NULL) AS missing_count, count(*) AS total_rows,"
        f" round_even(100.0 * count(*) FILTER ({name} IS NULL) / count(*), 1) AS missing_percent FROM po"
        for name in names
    )
    return f"WITH {_base()} {rows}"


ORACLE = {
    "timeline_failures": _failures(),
    "timeline_documents": _documents(),
    "timeline_document_teams": f"""{delayed(FULL)}, {_teams(FULL)} SELECT po_id, team, total_stages, delayed_stages,
        total_delay_days, average_delay_days FROM tm""",
    "timeline_small": _variant_sql("modular"),
    "timeline_legacy": _variant_sql("legacy"),
    "timeline_notebook": _variant_sql("notebook"),
    "timeline_full": f"{chain(FULL)} SELECT po_id, {_wide(FULL, 'd{k} AS date_{k}, m{k} AS method_{k}')} FROM tl",
    "stage_delay": _delay_rows(),
    "stage_delay_integrated":
        f"{delayed(SMALL, 'integrated')} SELECT po_id, {_wide(SMALL, 'x{k} AS days_{k}, y{k} AS status_{k}')} FROM dl",
    "method_counts": _method_counts(),
    "po_delay_summary": f"""{delayed(FULL)}, {_figures(FULL)} SELECT po_id, total_stages, delayed_stages, early_stages,
        on_time_stages, pending_stages, pending_overdue_stages, total_delay_days, critical_path_delays,
        {_average('total_delay_days', 'delayed_stages')} AS average_delay_days,
        {_average('delayed_only_days', 'delayed_stages')} AS average_delayed_only FROM fig""",
    "team_delay": f"""{delayed(FULL)}, {_teams(FULL)} SELECT po_id, team, total_stages, delayed_stages,
        total_delay_days, average_delay_days FROM tm""",
    "worst_team": f"""{delayed(FULL)}, {_teams(FULL)}, {_WORST} SELECT dl.po_id, team AS worst_team,
        average_delay_days AS worst_average_delay FROM dl LEFT JOIN worst ON dl.po_id = worst.po_id""",
    "insights": _insights(),
    "global_delay": _global(),
    "stage_matrix_actual":
        f"""{chain(FULL)} SELECT po_id, {_wide(FULL, 'CAST(a{k} AS DATE) AS "{name}"')} FROM tl""",
    "stage_matrix_computed":
        f"""{chain(FULL)} SELECT po_id, {_wide(FULL, 'CAST(d{k} AS DATE) AS "{name}"')} FROM tl""",
    "stage_matrix_delay": f"""{delayed(FULL)} SELECT po_id, {_wide(FULL, 'x{k} AS "{name}"')} FROM dl""",
    "stage_wide": f"""{delayed(SMALL, 'integrated')} SELECT po_id, po_created_date, ci_applicable, {_wide(SMALL,
        'CAST(d{k} AS DATE) AS "{name}_Date", x{k} AS "{name}_Delay_Days", y{k} AS "{name}_Status"')} FROM dl""",
    "stage_dependencies": _dependency_rows(),
    "stage_metadata": _metadata(),
    "null_profile": _null_profile(),
    "parse_dates": """SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN date_trunc('day', o_orderdate)
          WHEN 1 THEN o_orderdate WHEN 2 THEN date_trunc('day', o_orderdate)
          WHEN 3 THEN date_trunc('month', o_orderdate) + INTERVAL 24 DAY END AS parsed FROM orders""",
}
