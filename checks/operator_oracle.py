"""SQL for the single operators."""

from __future__ import annotations

_SITE = "split_part(url, '/', 3)"
_ROLL = """WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS g, o_orderstatus,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Reject' WHEN '2-HIGH' THEN 'Hold' ELSE 'Pay' END AS approval,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS day FROM orders)"""
_TERMS = """WITH t AS (SELECT p_partkey, p_size, CASE WHEN p_size % 7 = 0 THEN 'on receipt' WHEN p_size % 7 = 1 THEN '100% PI'
    WHEN p_size % 7 = 2 THEN '40% PI 60% BL 90' ELSE (p_size % 10 * 10) || '% PI 0d ' || (p_size % 4 * 10) || '% CI 15d '
      || (p_size % 3 * 10) || '% BL ' || (p_size + 20) || 'd' END AS terms FROM part)"""

ORACLE = {
    "incremental_latest": """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity FROM lineitem
      QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    "open_lines_latest": """WITH l AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1)
        SELECT l_orderkey, l_linenumber, l_shipdate, coalesce(o_orderpriority, 'No Order') AS priority, l_returnflag,
          CASE WHEN bool_or(l_returnflag = 'A') OVER (PARTITION BY l_orderkey) THEN 'A' ELSE l_returnflag END AS order_flag
        FROM l LEFT JOIN orders ON l_orderkey = o_orderkey
        WHERE l_linestatus <> 'F' AND l_quantity - CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END > 0""",
    "latest_per_key": """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    "latest_ties": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
        QUALIFY dense_rank() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC) = 1""",
    "earliest_per_key": """SELECT user_id, event_type, event_id, ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1""",
    "qualify_computed_key": f"""SELECT {_SITE} AS site, page_id, url FROM pages WHERE length({_SITE}) > 3
        QUALIFY row_number() OVER (PARTITION BY lower({_SITE}) ORDER BY length(url) DESC, page_id DESC) = 1""",
    "first_and_last": """SELECT user_id, event_type, count(*) AS attempts, min(ts) AS first_ts, max(ts) AS last_ts,
        arg_min(value, ts) AS first_value, arg_max(value, ts) AS last_value FROM events GROUP BY user_id, event_type""",
    "keep_first": """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""",
    "keep_last": """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""",
    "keep_by_priority": """SELECT o_custkey, o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Paid In Full'
          WHEN 'P' THEN 'Pending Approval' ELSE 'Open' END AS status FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'P' THEN 2 ELSE 3 END,
          o_orderdate, o_orderkey) = 1""",
    "distinct_values": "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem",
    "predicates": """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus IN ('O', 'P')
        AND o_orderpriority LIKE '%-%' AND o_orderpriority NOT LIKE '%NOT%' AND length(o_orderpriority) > 5
        AND trim(o_orderpriority) <> ''""",
    "rename_constants": "SELECT n_nationkey, n_name AS country, 'map' AS source, 1 AS weight FROM nation",
    "sample_first": "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 5",
    "membership_flag": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
        CASE WHEN l_orderkey IN (SELECT o_orderkey FROM orders) THEN 'Available on VP' ELSE 'Not Available on VP' END AS on_portal
        FROM lineitem""",
    "lookup_default": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
        coalesce(o_orderstatus, 'Missing') AS status, o_orderdate AS ordered
        FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus <> 'P') ON l_orderkey = o_orderkey""",
    "lookup_first_match": """SELECT c_custkey, coalesce(o_orderpriority, 'Never ordered') AS first_priority FROM customer
        LEFT JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1)
          ON c_custkey = o_custkey""",
    "lookup_by_row_source": """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN coalesce(n_name, 'No nation')
        ELSE coalesce(r_name, 'No region') END AS place FROM customer
        LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON c_nationkey = r_regionkey""",
    "value_map": """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'soon'
        ELSE 'later' END AS when_due FROM orders""",
    "lookup_some_rows": """SELECT s_suppkey, CASE WHEN s_acctbal > 3000 THEN coalesce(n_name, 'Priority 3') ELSE 'Priority 3' END AS place
        FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 4 <> 0) ON s_nationkey = n_nationkey""",
    "header_lines": """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, o_orderstatus, o_orderdate
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
    "left_then_filter": """SELECT s_nationkey, max(l_shipdate) AS last_ship, max(l_extendedprice) AS top_price
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey WHERE s_nationkey NOT IN (1, 2, 3) GROUP BY s_nationkey""",
    "fanout_then_rank": """WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey
          ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_linestatus <> 'F' AND l_quantity > 0)
        SELECT o_custkey, o_orderkey FROM r WHERE rn = 1""",
    "star_preagg": """SELECT o_orderkey AS l_orderkey, first_return, last_ship, c_mktsegment FROM orders
        LEFT JOIN (SELECT l_orderkey, min(CASE WHEN l_returnflag = 'R' THEN l_shipdate END) AS first_return,
          max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
        LEFT JOIN customer ON o_custkey = c_custkey""",
    "union_override": """SELECT o_custkey, o_orderkey, status FROM (
          SELECT o_custkey, o_orderkey, o_orderstatus AS status, 0 AS src FROM orders
          UNION ALL SELECT c_custkey, 0, 'Hold', 1 FROM customer WHERE c_acctbal < 0)
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY src DESC, o_orderkey DESC) = 1""",
    "lookup_by_code": """SELECT c_custkey, (c_custkey % 30) || 'a' AS sub_key, n_name AS sub_status FROM customer
        LEFT JOIN nation ON c_custkey % 30 = n_nationkey""",
    "max_by_batch": """SELECT l_orderkey, max(l_shipdate) AS last_ship, max(l_quantity) AS top_quantity,
        max(l_returnflag) AS top_flag, max(l_partkey) AS top_part FROM lineitem GROUP BY l_orderkey""",
    "max_release_dates": """SELECT l_suppkey, max(CASE WHEN l_returnflag = 'R' THEN l_shipdate END) AS supplier_release,
        max(CASE WHEN l_linestatus = 'O' THEN l_shipdate END) AS forwarder_release FROM lineitem GROUP BY l_suppkey""",
    "cond_min": """SELECT user_id, min(CASE WHEN event_type = 'click' THEN ts END) AS first_click,
        min(CASE WHEN event_type = 'error' AND value > 20 THEN ts END) AS first_big_error FROM events GROUP BY user_id""",
    "list_and_sum": """SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), ', ' ORDER BY CAST(l_partkey AS VARCHAR)) AS parts,
        string_agg(l_returnflag, ', ' ORDER BY l_returnflag) AS flags, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units
        FROM lineitem GROUP BY l_orderkey""",
    "max_by_split_key": f"SELECT {_SITE} AS site, max(page_id) AS last_page FROM pages GROUP BY 1",
    "any_rollup": f"""{_ROLL} SELECT o_orderkey, CASE WHEN g IS NOT NULL AND bool_or(o_orderstatus = 'F') OVER (PARTITION BY g)
        THEN 'F' ELSE o_orderstatus END AS any_status FROM o""",
    "priority_rollup": f"""{_ROLL} SELECT o_orderkey, CASE WHEN g IS NULL THEN approval
        WHEN bool_or(approval = 'Reject') OVER w THEN 'Reject' WHEN bool_or(approval = 'Missing') OVER w THEN 'Missing'
        WHEN bool_or(approval <> 'Pay') OVER w THEN 'On Hold' ELSE 'Pay' END AS approved FROM o WINDOW w AS (PARTITION BY g)""",
    "all_rollup": f"""{_ROLL} SELECT o_orderkey, CASE WHEN g IS NULL THEN o_orderstatus
        WHEN bool_and(o_orderstatus = 'O') OVER (PARTITION BY g) THEN 'O' ELSE 'Pending Approval' END AS all_status FROM o""",
    "max_date_state": f"""{_ROLL} SELECT o_orderkey, CASE WHEN g IS NOT NULL THEN max(day) OVER w END AS last_day,
        CASE WHEN g IS NULL THEN 'No Batch' WHEN max(day) OVER w IS NULL THEN 'Not Scheduled' ELSE 'Scheduled' END AS state
        FROM o WINDOW w AS (PARTITION BY g)""",
    "text_parts": """SELECT p_partkey, split_part(p_brand, '#', 1) AS before_mark,
        CASE WHEN strpos(p_brand, '#') > 0 THEN substr(p_brand, strpos(p_brand, '#') + 1) END AS after_mark,
        CASE WHEN strpos(p_name, '_') > 0 THEN substr(p_name, strpos(p_name, '_') + 1) END AS after_missing,
        right(p_brand, 3) AS last_three,
        CASE WHEN strpos(p_brand, '#') > 0 THEN substr(p_brand, strpos(p_brand, '#') + 1, 1) ELSE '' END AS after_one,
        CASE WHEN strpos(p_name, '#') > 0 THEN substr(p_name, strpos(p_name, '#') + 1, 8) ELSE '' END AS after_none,
        split_part(p_name, ' ', 1) AS first_word, left(p_name, 1) AS first_char,
        nullif(regexp_extract(p_name, '^(\\S+)', 1), '') AS prefix, nullif(regexp_extract(p_name, '^(\\d+)', 1), '') AS no_prefix,
        p_partkey || p_brand AS joined, lower(trim(p_type)) AS lowered, CAST(length(p_name) AS INTEGER) AS size,
        p_name LIKE 'red%' AS is_red FROM part""",
    "parse_terms": f"""{_TERMS} SELECT p_partkey, TRY_CAST(split_part(terms, '%', 1) AS INTEGER) AS pi_value,
        coalesce(TRY_CAST(nullif(split_part(split_part(terms, '%', 2), 'd ', 2), '') AS INTEGER), 0) AS ci_value,
        coalesce(TRY_CAST(nullif(split_part(split_part(terms, '%', 3), 'd ', 2), '') AS INTEGER), 0) AS bl_value,
        coalesce(TRY_CAST(nullif(split_part(split_part(split_part(terms, '%', 4), ' ', 3), 'd', 1), '') AS INTEGER), 0) AS bl_days
        FROM t""",
    "terms_percent": f"""{_TERMS}, x AS (SELECT p_partkey,
          TRY_CAST(nullif(regexp_extract(terms, '(\\d+)% PI', 1), '') AS DOUBLE) AS pi,
          TRY_CAST(nullif(regexp_extract(terms, '(\\d+)% CI', 1), '') AS DOUBLE) AS ci,
          TRY_CAST(nullif(regexp_extract(terms, '(\\d+)% BL', 1), '') AS DOUBLE) AS bl,
          TRY_CAST(nullif(regexp_extract(terms, 'BL (\\d+)', 1), '') AS INTEGER) AS d FROM t)
        SELECT p_partkey, pi, ci, bl, CASE WHEN d >= 45 THEN d ELSE 0 END AS bl_days FROM x""",
    "date_math": """SELECT o_orderkey, o_orderdate + INTERVAL 7 DAY AS week_later, o_orderdate - INTERVAL 21 DAY AS weeks_earlier,
        o_orderdate + to_days(CAST(o_orderkey % 9 AS INTEGER)) AS some_later,
        CAST(floor((epoch_us(o_orderdate) - epoch_us(TIMESTAMP '1998-06-01 06:30:00')) / 86400000000.0) AS BIGINT) AS days_since,
        CAST(floor((epoch_us(TIMESTAMP '1998-06-01 06:30:00') - epoch_us(o_orderdate)) / 86400000000.0) AS BIGINT) AS days_until,
        date_trunc('minute', o_orderdate) AS read_back, CAST(NULL AS TIMESTAMP) AS no_such_day FROM orders""",
    "value_rules": """WITH c AS (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN ' ' WHEN c_custkey % 3 = 1 THEN c_mktsegment END AS note,
          (['CO','DE','US','BR'])[c_custkey % 4 + 1] AS market FROM customer)
        SELECT c_custkey, coalesce(nullif(trim(note), ''), 'No PRD Blocker Mentioned') AS remark,
          CASE WHEN trim(note) NOT IN ('', 'BUILDING') THEN trim(note) END AS kept, coalesce(note, c_mktsegment) AS ladder,
          coalesce(TRY_CAST(left(c_mktsegment, 1) AS INTEGER), 1) AS number, TRY_CAST(right(c_name, 4) AS INTEGER) AS digits,
          CASE WHEN market IN ('CO', 'MX', 'BR') THEN 'LATAM' ELSE market END AS mp,
          CASE WHEN market IN ('FR', 'BE', 'ES', 'PL', 'NL', 'SE', 'IT', 'DE') THEN 'Pan-EU' ELSE market END AS final_mp,
          CASE WHEN note = 'MACHINERY' THEN 'Yes' ELSE 'No' END AS machinery FROM c""",
    "status_labels": """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '14a. Documents Missing' ELSE
        (['Signed-Off','14c. FFW Sign-Off Missing','14b. SM Sign-Off Missing','14b. SM Sign-Off Missing','14a. Documents Missing'])
          [o_orderkey % 5 + 1] END AS label FROM orders""",
    "promote_header": "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation",
    "tracker_clean": """SELECT CAST(o_orderkey AS VARCHAR) AS batch_id,
        CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority ELSE '0' END AS "Delay Reason",
        CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority ELSE 'No SPD Blocker Mentioned' END AS final_status
        FROM orders WHERE o_orderkey % 5 NOT IN (0, 1)""",
    "at_snapshot": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_shipdate = TIMESTAMP '1998-06-01'",
    "split_errors": """SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS record_id,
        CASE WHEN o_orderkey IS NULL THEN 'no order' ELSE 'shipped before ordered' END AS error
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey IS NULL OR l_shipdate < o_orderdate""",
}
