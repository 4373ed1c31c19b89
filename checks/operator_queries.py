"""Queries for the single operators over whole test tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordertide.functions import dates, text, values
from ordertide.operators import (
    LatestState, all_of, any_of, cond_min, distinct_values, earliest, first_and_last, flag_exists, header_lines,
    inner_lookup, keep, keep_by_priority, latest, list_and_sum, lookup, lookup_first, lookup_switch,
    lookup_when, map_values, max_by_key, max_date_state, non_blank, open_lines, priority_of, rename,
    restrict_to, roll_up, sample_first, shipment_star, sub_text, union_override, with_constants,
)
from ordertide.operators.rollups import max_date
from ordertide.sources import at_snapshot, clean_tracker, conform, promote_header, split_errors

from .tables import staging_dir, table

LINE = ["l_orderkey", "l_linenumber"]
NEWEST = ["l_shipdate", "l_partkey", "l_suppkey"]


def _lines(spark, sf):
    return table(spark, sf, "lineitem")


def _latest(spark, sf):
    return latest(_lines(spark, sf), LINE, NEWEST)


def open_lines_latest(spark: SparkSession, sf: str) -> DataFrame:
    """Latest line state, open lines, order priority with a default, any returned line per order."""
    lines = _latest(spark, sf).withColumns({
        "status": F.when(F.col("l_linestatus") == "F", "Closed").otherwise("Open"),
        "received": F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(F.lit(0.0)),
    })
    lines = open_lines(lines, "status", "l_quantity", "received", memo=None)
    lines = lookup(lines, table(spark, sf, "orders"), {"l_orderkey": "o_orderkey"},
                   {"priority": "o_orderpriority"}, {"priority": "No Order"})
    lines = roll_up(lines, "l_orderkey", {"order_flag": any_of("l_returnflag", "A")})
    return lines.select("l_orderkey", "l_linenumber", "l_shipdate", "priority", "l_returnflag", "order_flag")


def latest_ties(spark, sf):
    rows = latest(_lines(spark, sf), ["l_orderkey"], ["l_shipdate"], ties=True)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


def qualify_computed_key(spark, sf):
    """Newest page per site, the site being cut out of the url."""
    pages = table(spark, sf, "pages").withColumn(
        "site", text.before(text.after(text.after("url", "/"), "/"), "/"))
    rows = latest(pages, [F.lower("site")], [F.length("url"), "page_id"])
    return rows.where(F.length("site") > 3).select("site", "page_id", "url")


def first_and_last_events(spark, sf):
    events = table(spark, sf, "events")
    return first_and_last(events, ["user_id", "event_type"], ["ts", "event_id"], ["ts", "value"])


def keep_priority(spark, sf):
    orders = table(spark, sf, "orders").withColumn("status", map_values("o_orderstatus", {
        "F": " Paid In Full", "P": "Pending Approval "}, "Open"))
    rows = keep_by_priority(orders, ["o_custkey"], "status", ("paid in full", "pending approval", "open"),
                            "best", ["o_orderdate", "o_orderkey"])
    return rows.select("o_custkey", "o_orderkey", F.trim("status").alias("status"))


def _kept(which):
    def query(spark, sf):
        rows = keep(table(spark, sf, "orders"), ["o_custkey"], which, "o_orderkey")
        return rows.select("o_custkey", "o_orderkey", "o_totalprice")
    return query


def predicates(spark, sf):
    orders = table(spark, sf, "orders")
    kept = orders.where(
        F.col("o_orderstatus").isin("O", "P") & F.col("o_orderpriority").like("%-%")
        & ~F.col("o_orderpriority").like("%NOT%") & (F.length("o_orderpriority") > 5)
    )
    return non_blank(kept, "o_orderpriority").select("o_orderkey", "o_orderstatus", "o_orderpriority")


def renamed_constants(spark, sf):
    df = with_constants(rename(table(spark, sf, "nation"), {"n_name": "country"}), {"source": "map", "weight": 1})
    return df.select("n_nationkey", "country", "source", "weight")


def membership(spark, sf):
    df = flag_exists(_lines(spark, sf), table(spark, sf, "orders"), {"l_orderkey": "o_orderkey"},
                     "on_portal", "Available on VP", "Not Available on VP")
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "on_portal")


def lookup_default(spark, sf):
    dim = table(spark, sf, "orders").where(F.col("o_orderstatus") != "P")
    df = lookup(_lines(spark, sf), dim, {"l_orderkey": "o_orderkey"},
                {"status": "o_orderstatus", "ordered": "o_orderdate"}, {"status": "Missing"})
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "status", "ordered")


def first_match(spark, sf):
    df = lookup_first(table(spark, sf, "customer"), table(spark, sf, "orders"), {"c_custkey": "o_custkey"},
                      ("first_priority", "o_orderpriority"), "Never ordered", ["o_orderdate", "o_orderkey"])
    return df.select("c_custkey", "first_priority")


def by_row_source(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("key"), "c_mktsegment")
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), "n_name")
    regions = table(spark, sf, "region").select(F.col("r_regionkey").alias("key"), "r_name")
    df = lookup_switch(customers, F.col("c_mktsegment") == "BUILDING", (nations, "n_name", "No nation"),
                       (regions, "r_name", "No region"), "key", "place")
    return df.select("c_custkey", "place")


def value_map(spark, sf):
    label = map_values("o_orderpriority", {"1-URGENT": "now", "2-HIGH": "soon"}, "later")
    return table(spark, sf, "orders").select("o_orderkey", label.alias("when_due"))


def some_rows(spark, sf):
    nations = table(spark, sf, "nation").where(F.col("n_nationkey") % 4 != 0)
    df = lookup_when(table(spark, sf, "supplier"), F.col("s_acctbal") > 3000, nations,
                     {"s_nationkey": "n_nationkey"}, ("place", "n_name"), "Priority 3")
    return df.select("s_suppkey", "place")


def headers(spark, sf):
    orders = table(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    df = header_lines(orders, _lines(spark, sf), "l_orderkey")
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "o_orderstatus", "o_orderdate")


def left_then_filter(spark, sf):
    suppliers = table(spark, sf, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    df = inner_lookup(_lines(spark, sf), suppliers, "l_suppkey", ~F.col("s_nationkey").isin(1, 2, 3))
    return max_by_key(df, "s_nationkey", {"last_ship": "l_shipdate", "top_price": "l_extendedprice"})


def fanout_then_rank(spark, sf):
    """Latest order per customer among orders with an open line; lines do not multiply orders."""
    lines = open_lines(_lines(spark, sf).withColumn("none", F.lit(0.0)), "l_linestatus", "l_quantity", "none",
                       memo=None, closed=("F",))
    kept = restrict_to(table(spark, sf, "orders"), lines, {"o_orderkey": "l_orderkey"})
    return latest(kept, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


def star(spark, sf):
    """Orders with reduced sides: a conditional earliest date, a list with sums, customer terms."""
    lines = _lines(spark, sf)
    notes = cond_min(lines, "l_orderkey", {"first_return": (F.col("l_returnflag") == "R", "l_shipdate")})
    bills = max_by_key(lines, "l_orderkey", {"last_ship": "l_shipdate"})
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    df = shipment_star(table(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey"), {
        "notes": ("l_orderkey", notes), "bills": ("l_orderkey", bills), "customers": ("o_custkey", customers)})
    return df.select("l_orderkey", "first_return", "last_ship", "c_mktsegment")


def override(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderkey", F.col("o_orderstatus").alias("status"))
    manual = table(spark, sf, "customer").where(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").alias("o_custkey"), F.lit(0).cast("long").alias("o_orderkey"), F.lit("Hold").alias("status"))
    return union_override([orders, manual], ["o_custkey"], ["o_orderkey"])


def by_code(spark, sf):
    dim = table(spark, sf, "nation").select(
        F.concat(F.col("n_nationkey").cast("string"), F.lit("a")).alias("code"), F.col("n_name").alias("sub_status"))
    lines = table(spark, sf, "customer").select(
        "c_custkey", F.concat((F.col("c_custkey") % 30).cast("string"), F.lit("a")).alias("sub_key"))
    return sub_text(lines, dim, "sub_key").select("c_custkey", "sub_key", "sub_status")


def max_by_batch(spark, sf):
    return max_by_key(_lines(spark, sf), "l_orderkey", {
        "last_ship": "l_shipdate", "top_quantity": "l_quantity", "top_flag": "l_returnflag", "top_part": "l_partkey"})


def release_dates(spark, sf):
    lines = _lines(spark, sf).withColumns({
        "supplier_release": F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")),
        "forwarder_release": F.when(F.col("l_linestatus") == "O", F.col("l_shipdate"))})
    return max_by_key(lines, "l_suppkey", ["supplier_release", "forwarder_release"])


def conditional_min(spark, sf):
    events = table(spark, sf, "events")
    return cond_min(events, "user_id", {
        "first_click": (F.col("event_type") == "click", "ts"),
        "first_big_error": ((F.col("event_type") == "error") & (F.col("value") > 20), "ts")})


def lists_and_sums(spark, sf):
    lines = _lines(spark, sf).withColumn("units", F.col("l_quantity").cast("long"))
    return list_and_sum(lines, "l_orderkey", {"parts": "l_partkey", "flags": "l_returnflag"}, {"units": "units"})


def split_key(spark, sf):
    site = text.before(text.after(text.after("url", "/"), "/"), "/").alias("site")
    return max_by_key(table(spark, sf, "pages"), site, {"last_page": "page_id"})


def _rolled(spark, sf, rules, group="o_custkey"):
    orders = table(spark, sf, "orders").withColumns({
        "o_custkey": F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey")),
        "approval": map_values("o_orderpriority", {"1-URGENT": "Reject", "2-HIGH": "Hold"}, "Pay"),
        "day": F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("timestamp")),
    })
    return roll_up(orders, group, rules).select("o_orderkey", *rules)


def text_parts(spark, sf):
    part = table(spark, sf, "part")
    return part.select(
        "p_partkey", text.before("p_brand", "#").alias("before_mark"), text.after("p_brand", "#").alias("after_mark"),
        text.after("p_name", "_").alias("after_missing"), text.last_n("p_brand", 3).alias("last_three"),
        text.after_n("p_brand", "#", 1).alias("after_one"), text.after_n("p_name", "#", 8).alias("after_none"),
        text.first_word("p_name").alias("first_word"), text.first_char("p_name").alias("first_char"),
        text.prefix("p_name", r"^(\S+)").alias("prefix"), text.prefix("p_name", r"^(\d+)").alias("no_prefix"),
        text.joined("p_partkey", "p_brand").alias("joined"), F.lower(F.trim("p_type")).alias("lowered"),
        F.length("p_name").alias("size"), F.col("p_name").startswith("red").alias("is_red"),
    )


def _terms(part):
    n = F.col("p_size")
    words = F.concat(
        (n % 10 * 10).cast("string"), F.lit("% PI 0d "), (n % 4 * 10).cast("string"), F.lit("% CI 15d "),
        (n % 3 * 10).cast("string"), F.lit("% BL "), (n + 20).cast("string"), F.lit("d"))
    return F.when(n % 7 == 0, "on receipt").when(n % 7 == 1, "100% PI").when(n % 7 == 2, "40% PI 60% BL 90").otherwise(words)


def terms_split(spark, sf):
    part = table(spark, sf, "part").withColumn("terms", _terms(None))
    return part.select("p_partkey", *[column.alias(name) for name, column in text.parse_terms("terms").items()])


def terms_percent(spark, sf):
    part = table(spark, sf, "part").withColumn("terms", _terms(None))
    return part.select("p_partkey", text.pct_of("terms", "PI").alias("pi"), text.pct_of("terms", "CI").alias("ci"),
                       text.pct_of("terms", "BL").alias("bl"), text.bl_days("terms").alias("bl_days"))


def date_math(spark, sf):
    a, b = F.col("o_orderdate").cast("timestamp"), F.lit("1998-06-01 06:30:00").cast("timestamp")
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.plus_days(a, 7).alias("week_later"), dates.plus_days(a, -21).alias("weeks_earlier"),
        dates.plus_days(a, (F.col("o_orderkey") % 9).cast("int")).alias("some_later"),
        dates.days_between(a, b).alias("days_since"), dates.days_between(b, a).alias("days_until"),
        dates.to_ts(F.date_format(a, "dd.MM.yyyy HH:mm"), "dd.MM.yyyy HH:mm").alias("read_back"),
        dates.to_ts(F.lit("31.02.2000"), "dd.MM.yyyy").alias("no_such_day"))


def value_rules(spark, sf):
    customers = table(spark, sf, "customer").withColumn("note", F.when(
        F.col("c_custkey") % 3 == 0, " ").when(F.col("c_custkey") % 3 == 1, F.col("c_mktsegment")))
    market = F.element_at(F.array(*[F.lit(m) for m in ("CO", "DE", "US", "BR")]), (F.col("c_custkey") % 4).cast("int") + 1)
    return customers.select(
        "c_custkey", values.blank_to("note", "No PRD Blocker Mentioned").alias("remark"),
        values.present("note", ["BUILDING"]).alias("kept"),
        values.first_present("note", "c_mktsegment").alias("ladder"),
        values.to_number(text.first_char("c_mktsegment"), "int", 1).alias("number"),
        values.to_number(F.substring("c_name", -4, 4), "int").alias("digits"),
        values.latam_group(market).alias("mp"), values.pan_eu_group(market).alias("final_mp"),
        values.yes_no(values.is_value("note", "MACHINERY")).alias("machinery"))


def status_labels(spark, sf):
    """Document state of packing lists as a label; unknown and missing states count as missing."""
    state = F.element_at(F.array(*[F.lit(s) for s in (
        "accepted-ffw", "accepted-sm", "ocr1-accepted", "uploaded", "rejected-ffw")]), (F.col("o_orderkey") % 5).cast("int") + 1)
    label = map_values("state", {
        "accepted-ffw": "Signed-Off", "accepted-sm": "14c. FFW Sign-Off Missing",
        "ocr1-accepted": "14b. SM Sign-Off Missing", "uploaded": "14b. SM Sign-Off Missing"}, "14a. Documents Missing")
    return table(spark, sf, "orders").withColumn("state", F.when(F.col("o_orderkey") % 7 != 0, state)).select(
        "o_orderkey", label.alias("label"))


def header_row(spark, sf):
    """A sheet whose first row is its header."""
    nation = table(spark, sf, "nation")
    rows = nation.select((F.col("n_nationkey") + 1).alias("seq"), F.col("n_nationkey").cast("string").alias("_c0"), F.col("n_name").alias("_c1"))
    top = nation.where(F.col("n_nationkey") == 0).select(F.lit(0).alias("seq"), F.lit(" id ").alias("_c0"), F.lit("name").alias("_c1"))
    return promote_header(rows.unionByName(top), "seq")


def tracker(spark, sf):
    orders = table(spark, sf, "orders").withColumns({
        "batch_id": F.when(F.col("o_orderkey") % 5 == 0, " ").when(F.col("o_orderkey") % 5 != 1, F.col("o_orderkey").cast("string")),
        "Delay Reason": F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).otherwise("0")})
    return clean_tracker(conform(orders.withColumnRenamed("o_clerk", "clerk"), ["o_orderkey"]), "batch_id", ["Delay Reason"], {
        "final_status": values.blank_to("Delay Reason", "No SPD Blocker Mentioned", ["0"])})


def snapshot(spark, sf):
    rows = at_snapshot(_lines(spark, sf), "1998-06-01", "l_shipdate")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def errors(spark, sf):
    checks = {"no order": F.col("o_orderkey").isNull(), "shipped before ordered": F.col("l_shipdate") < F.col("o_orderdate")}
    lines = _lines(spark, sf).join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    lines = lines.withColumn("id", F.concat_ws("-", *LINE, "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd")))
    return split_errors(lines, checks, "id")[1]


def incremental_latest(spark, sf):
    """The change log merged in three loads, the second with late rows, into a kept latest state."""
    state = LatestState(f"{staging_dir(spark).rstrip('/')}/state-{uuid.uuid4().hex}", LINE, NEWEST, buckets=16)
    lines = _lines(spark, sf).select(*LINE, *NEWEST, "l_quantity")
    year = F.year("l_shipdate")
    for part in (year < 1997, (year == 1997) | (year == 2001), (year > 1997) & (year < 2001)):
        state.merge(lines.where(part))
    return state.read(spark).select(*LINE, *NEWEST, "l_quantity")


QUERIES = {
    "incremental_latest": incremental_latest,
    "open_lines_latest": open_lines_latest,
    "latest_per_key": lambda spark, sf: _latest(spark, sf).select(*LINE, "l_shipdate", "l_partkey", "l_suppkey", "l_quantity"),
    "latest_ties": latest_ties,
    "earliest_per_key": lambda spark, sf: earliest(table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select(
        "user_id", "event_type", "event_id", "ts"),
    "qualify_computed_key": qualify_computed_key,
    "first_and_last": first_and_last_events,
    "keep_first": _kept("first"),
    "keep_last": _kept("last"),
    "keep_by_priority": keep_priority,
    "distinct_values": lambda spark, sf: distinct_values(_lines(spark, sf), ["l_returnflag", "l_linestatus", "l_linenumber"]),
    "predicates": predicates,
    "rename_constants": renamed_constants,
    "sample_first": lambda spark, sf: sample_first(table(spark, sf, "orders"), 5, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "o_orderdate"),
    "membership_flag": membership,
    "lookup_default": lookup_default,
    "lookup_first_match": first_match,
    "lookup_by_row_source": by_row_source,
    "value_map": value_map,
    "lookup_some_rows": some_rows,
    "header_lines": headers,
    "left_then_filter": left_then_filter,
    "fanout_then_rank": fanout_then_rank,
    "star_preagg": star,
    "union_override": override,
    "lookup_by_code": by_code,
    "max_by_batch": max_by_batch,
    "max_release_dates": release_dates,
    "cond_min": conditional_min,
    "list_and_sum": lists_and_sums,
    "max_by_split_key": split_key,
    "any_rollup": lambda spark, sf: _rolled(spark, sf, {"any_status": any_of("o_orderstatus", "F")}),
    "priority_rollup": lambda spark, sf: _rolled(spark, sf, {"approved": priority_of("approval", ("Reject", "Missing"), "Pay", "On Hold")}),
    "all_rollup": lambda spark, sf: _rolled(spark, sf, {"all_status": all_of("o_orderstatus", "O", "Pending Approval")}),
    "max_date_state": lambda spark, sf: _rolled(spark, sf, {"last_day": max_date("day"), "state": max_date_state("day")}),
    "text_parts": text_parts,
    "parse_terms": terms_split,
    "terms_percent": terms_percent,
    "date_math": date_math,
    "value_rules": value_rules,
    "status_labels": status_labels,
    "promote_header": header_row,
    "tracker_clean": tracker,
    "at_snapshot": snapshot,
    "split_errors": errors,
}
