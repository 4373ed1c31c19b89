"""The timeline against a small row-by-row evaluation of its rules, and its configuration checks."""

import json
import random
from datetime import datetime, timedelta

import pytest
from helpers import plan
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.timeline_queries import SMALL_CONFIG
from ordertide.functions.dates import parse_any_date
from ordertide.plans.timeline import (
    TIMELINE_DATES, Stage, documents, explain_stages, flat_tables, insights, load_stages, method_counts, nested_results,
    po_delay_summary, read_documents, stage_delay, stages_from_dict, stages_long, standard_stages, team_delay, timeline,
    timeline_or_failures, topological_order, validate, worst_team,
)
from ordertide.plans.timeline.expressions import Scope, compile_term, parse
from ordertide.sources import write_json

SCHEMA = T.StructType(
    [T.StructField("po_id", T.StringType())] + [T.StructField(name, T.TimestampType()) for name in TIMELINE_DATES]
    + [T.StructField(name, T.IntegerType()) for name in ("pi_applicable", "ci_applicable", "plt")]
)


def day(n):
    return datetime(2025, 1, 1) + timedelta(hours=n)


def random_rows(count, seed):
    pick = random.Random(seed)
    data = []
    for at in range(count):
        density = pick.random()
        dates = [day(pick.randint(0, 4000)) if pick.random() < density else None for _ in TIMELINE_DATES]
        data.append((f"PO{at}", *dates, pick.choice((0, 1, None)), pick.choice((0, 1, None)), pick.choice((None, 10, 40))))
    return data


def walk(row, variant):
    """Stage dates and methods of one row of the six-stage configuration, from the written rules."""
    v = dict(zip([field.name for field in SCHEMA], row))
    plus = lambda moment, days: moment + timedelta(days=days) if moment and days is not None else None
    top = lambda *dates: max([d for d in dates if d], default=None)
    made = {}

    def stage(key, before, actual, fallback, lead):
        reached = top(*[made[item][0] for item in before])
        act = v.get(actual)
        due = plus(reached, lead)
        if variant == "modular":
            if not reached and not fallback:
                out = (None, "failed")
            elif reached and act:
                out = (act, "actual_over_precedence") if act >= reached else (due, "precedence_over_actual")
            elif act:
                out = (act, "actual_only")
            else:
                out = (due, "precedence_only") if reached else (None, "fallback")
        elif variant == "legacy":
            if reached and act:
                out = (act, "actual_over_precedence") if act >= reached else (reached, "precedence_over_actual")
            elif act:
                out = (act, "actual_only")
            elif reached:
                out = (due, "precedence_only")
            else:
                out = (None, None if fallback else "failed")
        else:
            if reached and act:
                out = (act, "actual_over_precedence") if act >= due else (due, "precedence_over_actual")
            elif act:
                out = (act, "actual_only")
            elif reached:
                out = (due, "precedence_only")
            else:
                out = (plus(fallback, lead), "fallback") if fallback else (None, "failed")
        made[key] = out

    stage("1", [], "receive_first_prd_date", v["po_created_date"], 4)
    stage("2", ["1"], "sm_signoff_ts", None, 1)
    stage("3", ["1"] if v["ci_applicable"] == 0 else [], "qc_schedule_date",
          top(v["batch_created_ts"], plus(v["po_sm_date_value"], 6)), 2)
    stage("4", ["3", "2"] if v["pi_applicable"] != 1 else ["1"], "ffw_booking_ts", None, 7)
    stage("5", ["3", "4"], "actual_shipping_date", plus(made["3"][0], 9), 0)
    plt = None if v["plt"] is None else v["plt"] - 8
    stage("6", [], "", top(v["item_receipt_date"], plus(made["5"][0], plt)), 3)
    return made


@pytest.mark.parametrize("variant", ["modular", "legacy", "notebook"])
def test_random_rows_match_the_rules(spark, variant):
    data = random_rows(400, 7)
    stages = stages_from_dict(SMALL_CONFIG)
    got = timeline(spark.createDataFrame(data, SCHEMA), stages, variant, ["po_id"]).collect()
    for row, result in zip(sorted(data), sorted(got, key=lambda r: r.po_id)):
        expected = walk(row, variant)
        for stage in stages:
            found = result[f"stage_{stage.stage_id}"]
            assert (found.date, found.method) == expected[stage.stage_id], (row[0], stage.stage_id)


def test_fusing_levels_changes_nothing(spark):
    df = spark.createDataFrame(random_rows(60, 3), SCHEMA)
    one, four = (timeline(df, standard_stages(), keep=["po_id"], fuse=n).orderBy("po_id").collect() for n in (2, 5))
    assert one == four


def test_timeline_needs_no_shuffle_and_no_python(spark, sf):
    from checks.timeline_queries import QUERIES
    for name in ("timeline_full", "po_delay_summary", "insights"):
        text = plan(QUERIES[name](spark, sf))
        shuffles = [line for line in text.splitlines() if "Exchange " in line and "BroadcastExchange" not in line]
        assert len(shuffles) == 1 and "REPARTITION_BY_COL" in shuffles[0], shuffles  # that deals out the test rows
        assert "Python" not in text and "Pandas" not in text


def test_summaries_of_a_sample_line(spark):
    dates = {name: None for name in TIMELINE_DATES}
    dates.update(po_created_date=day(0), po_approval_date=day(24), supplier_confirmation_date=day(24 * 9 - 1))
    df = spark.createDataFrame([("PO1", *dates.values(), 1, 0, None)], SCHEMA)
    stages = standard_stages()
    delayed = stage_delay(timeline(df, stages, keep=["po_id"]), stages, "2025-03-01")
    long = {row.stage_id: row for row in stages_long(delayed, stages, ["po_id"]).collect()}
    # Target of stage 1 is its creation date; of stage 2 the approval date plus three days.
    assert (long["1"].delay_days, long["1"].delay_status) == (1, "delayed")
    assert (long["2"].delay_days, long["2"].delay_reason) == (4, "Actual completion 4 days after target")
    assert long["3"].date == long["2"].date + timedelta(days=1) and long["3"].method == "precedence_only"
    assert long["15"].method == "failed" and long["15"].delay_status == "unknown"
    counts = method_counts(delayed, stages, ["po_id"]).first()
    assert counts.total_stages == 31 and sum(counts[m] for m in ("actual_only", "precedence_only", "actual_over_precedence",
                                                               "precedence_over_actual", "fallback", "failed")) == 31


def test_overdue_rounds_down_and_pending_waits(spark):
    stages = [Stage("1", "Only", "po_approval_date", None, "po_created_date", 0)]
    df = spark.createDataFrame([("a", day(0)), ("b", day(48))], "po_id string, po_created_date timestamp").withColumn(
        "po_approval_date", F.lit(None).cast("timestamp"))
    found = stage_delay(timeline(df, stages), stages, day(47)).orderBy("po_id").collect()
    assert [(r.delay_1.status, r.delay_1.days) for r in found] == [("pending_overdue", 1), ("pending", None)]


def test_early_by_an_hour_is_a_day_early(spark):
    stages = [Stage("1", "Only", "po_approval_date", None, "po_created_date", 0)]
    df = spark.createDataFrame([("a", day(10), day(9))], "po_id string, po_created_date timestamp, po_approval_date timestamp")
    assert stage_delay(timeline(df, stages), stages, day(0)).first().delay_1.days == -1


def test_configuration_file_round_trip(tmp_path):
    path = tmp_path / "stages.json"
    path.write_text(json.dumps(SMALL_CONFIG))
    assert load_stages(str(path)) == stages_from_dict(SMALL_CONFIG)


def test_order_follows_stage_references():
    order = [stage.stage_id for stage in topological_order(standard_stages())]
    assert order.index("8") < order.index("10") and order.index("16") < order.index("18")


def test_circles_are_refused_also_for_long_ids():
    with pytest.raises(ValueError, match="circle"):
        validate([Stage("10", "a", None, "['11']"), Stage("11", "b", None, None, "stage_10+1")])


@pytest.mark.parametrize("stage", [Stage(" ", "a"), Stage("1", "a", lead_time=-1), Stage("1", "a", lead_time=True)])
def test_bad_stages_are_refused(stage):
    with pytest.raises(ValueError):
        validate([stage])


def test_expressions(spark):
    df = spark.createDataFrame(
        [(day(0), day(36), 3, None, 2.5)], "a timestamp, b timestamp, n int, m int, x double")
    scope = Scope(df.schema, {})

    def value(text):
        return df.select(compile_term(parse(text), scope).column.alias("v")).first().v

    assert value("a + 2") == day(48) and value("2 + a") == day(48) and value("b - 1") == day(12)
    assert value("b - a") == 1 and value("a - b") == -2
    assert value("a + x") == day(60) and value("add_days(a, x)") == day(48)
    assert value("add_days(a, m)") is None and value("add_days(n, 1)") is None and value("a + nowhere") is None
    assert value("max(a, n, b)") == day(36) and value("max(a)") == day(0) and value("max(n)") is None
    assert value("n / 0") is None and value("n * 2 - 1") == 5 and value("n / 2") == 1.5
    assert value("m == 1") is False and value("m != 1") is True and value("n >= 3") is True
    assert value("cond(m == 1, a, b)") == day(36) and value("iff(n < 4, a, b)") == day(0)
    for text in ("cond(n, a)", "n < 2 < 3", "min(a, b)", "__import__('os')", "a ** 2", "[x for x in a]"):
        with pytest.raises(ValueError):
            compile_term(parse(text), scope)


def test_nested_results_as_json(spark, tmp_path):
    stages = stages_from_dict(SMALL_CONFIG)
    df = spark.createDataFrame(random_rows(5, 1), SCHEMA)
    delayed = stage_delay(timeline(df, stages, keep=["po_id"]), stages, day(9000), "integrated")
    write_json(nested_results(delayed, stages, ["po_id"]), str(tmp_path / "out"))
    documents = [json.loads(line) for part in (tmp_path / "out").glob("part-*") for line in part.read_text().splitlines()]
    assert len(documents) == 5
    assert set(documents[0]["stages"]) == set("123456") and documents[0]["summary"]["total_stages"] == 6


def test_every_row_is_in_the_timeline_or_has_a_fatal_error(spark):
    stages = [
        Stage("1", "Ready", "ready", None, "made", 1), Stage("2", "Sent", "sent", "cond(n > 3, ['1'], [])", "max(made, sent)", 0),
        Stage("3", "There", None, "cond(stage_2 > made, ['2'], cond(n == 9, ['1'], []))", "add_days(stage_2, n)", 0),
    ]
    df = spark.createDataFrame(
        [("a", day(0), "2025-01-05", None, 5), ("b", day(0), "soon", "2025-01-06", 5), ("c", day(0), " ", "never", None), ("d", day(0), None, "NA", 1)],
        "id string, made timestamp, ready string, sent string, n int")
    good, failed = timeline_or_failures(df, stages, ["id"], keep=["id", "ready"], text_dates=["ready", "sent"])
    found = {(r["id"], r["stage_id"], r["part"], r["fatal"]): r["error"] for r in failed.collect()}
    assert found == {
        ("b", "1", "actual", False): "ready is no date", ("c", "2", "preceding", True): "n > 3: a side is missing",
        ("c", "2", "actual", False): "sent is no date", ("c", "2", "fallback", False): "sent is no date",
        ("c", "3", "preceding", True): "stage_2 > made: a side is missing", ("d", "3", "preceding", True): "stage_2 > made: a side is missing",
    }
    rows = {r["id"]: r for r in good.collect()}
    assert set(rows) == {"a", "b"} and good.columns == ["id", "ready", "stage_1", "stage_2", "stage_3"]
    assert rows["a"]["stage_1"]["date"] == datetime(2025, 1, 5) and rows["b"]["stage_1"]["actual_date"] is None
    strict, _ = timeline_or_failures(df, stages, ["id"], keep=["id"], text_dates=["ready", "sent"], fatal=("preceding", "actual", "fallback"))
    assert [r["id"] for r in strict.collect()] == ["a"]


def test_documents_come_back_whole(spark, tmp_path):
    stages = stages_from_dict(SMALL_CONFIG)
    df = spark.createDataFrame(random_rows(60, 5), SCHEMA)
    delayed = stage_delay(timeline(df, stages), stages, day(3000))
    made = documents(delayed, stages, ["po_id"])
    write_json(made, str(tmp_path / "out"))
    read = read_documents(spark, str(tmp_path / "out"))
    before, after = flat_tables(made, ["po_id"]), flat_tables(read, ["po_id"])
    assert set(before) == {"summary", "stages", "dependencies", "teams", "insights"}
    for name in before:
        assert before[name].schema.simpleString() == after[name].schema.simpleString()
        assert sorted(map(repr, before[name].collect())) == sorted(map(repr, after[name].collect())), name
    ids = lambda df, *columns: sorted(map(repr, (tuple(r) for r in df.select(*columns).collect())))
    long = stages_long(delayed, stages, ["po_id"])
    shown = ("po_id", "stage_id", "date", "method", "target_date", "delay_days", "delay_status", "delay_reason", "team_responsible", "target_timestamp")
    assert ids(after["stages"], *shown) == ids(long, *shown)
    teams = ("po_id", "team", "total_stages", "delayed_stages", "total_delay_days", "average_delay_days")
    assert ids(after["teams"], *teams) == ids(team_delay(delayed, stages, ["po_id"]), *teams)
    told = explain_stages(delayed, stages, ["po_id"])
    assert ids(after["stages"], "po_id", "stage_id", "source", "decision", "reason") == ids(told, "po_id", "stage_id", "source", "decision", "reason")
    needs = told.select("po_id", "stage_id", F.posexplode("dependencies").alias("position", "d")).select("po_id", "stage_id", "position", "d.*")
    assert [r[3] for r in after["dependencies"].orderBy("po_id", "stage_id", "position").collect()] == [
        r[3] for r in needs.orderBy("po_id", "stage_id", "position").collect()]
    figures = ("po_id", "delayed_stages", "total_delay_days", "average_delay_days", "critical_path_delays")
    assert ids(after["summary"], *figures) == ids(po_delay_summary(delayed, stages, ["po_id"]), *figures)
    texts = insights(delayed, stages, ["po_id"]).select("po_id", F.posexplode("insights").alias("position", "insight"))
    assert ids(after["insights"], "po_id", "position", "insight") == ids(texts, "po_id", "position", "insight")


def _old_any_date(c):
    """How texts were read before: all formats tried, in order, on every text."""
    text = F.trim(F.col(c))
    usable = F.when((text != "") & (text != "NA"), text)
    formats = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy", "dd/MM/yyyy")
    return F.coalesce(*[F.try_to_timestamp(usable, F.lit(f)) for f in formats], usable.try_cast("timestamp"))


def test_dates_are_read_as_before_and_formats_tried_only_on_texts_that_look_like_them(spark):
    texts = ["2024-02-03", "2024-02-30", "2024-02-03 04:05:06", "2024-02-03 24:00:00", "2024-02-03T04:05:06.7", "2024-2-3", "2024-02", "2024",
             "12/25/2020", "25/12/2020", "02/30/2020", "30/02/2020", "04/31/2020", "13/13/2020", "1/2/2020", "01/02/2020", "01/02/20", "01/02/+12020",
             "01/02/-2020", "01/02/12020", "00/01/2020", "01/02/2020 10:00", "2020-01-01 10:00:00 Europe/Paris", "2020-01-01 10:00:00+02:00",
             "+12020-01-01", "12020-01-01", "-0044-03-15", "0000-01-01", "01/02/0000", "soon", "NA", " ", "", None, " 2024-02-03 ", "10:11", "T10:11",
             "20240203", "2024-02-03 4:5:6", "2024-02-03 04:05", "01-02-2020", "2024/02/03", "1/12/2020", "１2/12/2020"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in df.select("t", F.unix_micros(_old_any_date("t")).alias("old"), F.unix_micros(parse_any_date("t")).alias("new")).collect():
        assert row.old == row.new, row
    text = plan(df.select(parse_any_date("t").alias("d")))
    assert "yyyy-MM-dd" not in text and "RLIKE" in text


def test_long_figures_are_compiled_and_not_interpreted(spark):
    """Lambda functions over arrays of stages would be interpreted, with all that the stages are made of."""
    df, stages = spark.createDataFrame(random_rows(5, 3), SCHEMA), standard_stages()
    made = timeline(df, stages, keep=["po_id"])
    delays = stage_delay(made, stages, "2025-03-01")
    for found in (method_counts(made, stages, ["po_id"]), po_delay_summary(delays, stages, ["po_id"]), worst_team(delays, stages, ["po_id"])):
        assert "lambda" not in plan(found)
    good, failed = timeline_or_failures(made.select("po_id").withColumn("d", F.lit("x")), [Stage("1", "A", "d", None, None, 1)], ["po_id"], text_dates=["d"])
    assert "lambda" not in plan(good) + plan(failed) and failed.count() == 5 and good.count() == 5


def test_methods_of_more_stages_than_one_number_counts(spark):
    stages = [Stage(str(n), f"Stage {n}", "po_approval_date", None, "po_created_date", n) for n in range(1, 131)]
    df = spark.createDataFrame([("a", day(0), day(5)), ("b", None, None)], "po_id string, po_created_date timestamp, po_approval_date timestamp")
    a, b = method_counts(timeline(df, stages, keep=["po_id"]), stages, ["po_id"]).orderBy("po_id").collect()
    assert (a.total_stages, a.calculated_stages, a.actual_only, a.failed) == (130, 130, 130, 0)
    assert (b.total_stages, b.calculated_stages, b.actual_only, b.failed) == (130, 0, 0, 130)
