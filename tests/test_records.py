"""Parsing, change filters, the log router, configured routing."""

import json

import pytest
from pyspark.sql import functions as F

from helpers import change, changes, dictionary, page, page_log
from millrace import schemas
from millrace.operators import cdc, logs, routing
from millrace.plans import simple_facts, trade_facts
from millrace.sources import readers


def text(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_dirty_split_keeps_every_record_once(spark, rows):
    good = '{"common":{"mid":"m"},"page":{"page_id":"home"},"ts":1}'
    parsed = logs.parse_logs(text(spark, good, "{bad", "", "null", "[1]", '{"ts":'))
    assert rows(logs.dirty(parsed)) == sorted(
        [("{bad",), ("",), ("null",), ("[1]",), ('{"ts":',)], key=repr
    )
    assert rows(logs.clean(parsed), "common.mid", "ts") == [("m", 1)]


def log_text(**fields):
    return json.dumps({"common": {"mid": "m", "vc": "v"}, "ts": 7, **fields}, separators=(",", ":"))


def test_router_outputs(spark, rows):
    p = {"page_id": "home"}
    item = {"item": "1", "item_type": "sku_id", "order": 1}
    parsed = logs.parse_logs(
        text(
            spark,
            log_text(err={"code": 1}, start={"entry": "icon"}),
            log_text(err={"code": 2}, page=p),
            log_text(start={"entry": "push"}),
            log_text(page=p, displays=[], actions=[]),
            log_text(page=p, displays=[item], actions=[{"action_id": "a", "ts": 9}]),
            log_text(page=p, displays=[item, item]),
            log_text(displays=[item]),
        )
    )
    out = logs.route(logs.clean(parsed))
    assert rows(out["error"], "err") == [('{"code":1}',), ('{"code":2}',)]
    assert rows(out["start"], "start") == [('{"entry":"icon"}',), ('{"entry":"push"}',)]
    # start and page exclude each other; an error goes on to its page output
    assert out["page"].count() == 5
    assert "err" not in out["page"].columns and "displays" not in out["page"].columns
    # a record without a page is not a failure: its page id is null
    assert rows(out["display"], "page_id", "common", "ts") == sorted(
        [("home", '{"mid":"m","vc":"v"}', 7)] * 3 + [(None, '{"mid":"m","vc":"v"}', 7)], key=repr
    )
    # actions keep their own time
    assert rows(out["action"], "action_id", "ts") == [("a", 9)]


def test_single_displays_are_kept_by_default_and_dropped_with_min_size_2(spark):
    p, item = {"page_id": "home"}, {"item": "1"}
    clean = logs.clean(
        logs.parse_logs(
            text(spark, log_text(page=p, displays=[item]), log_text(page=p, displays=[item] * 2))
        )
    )
    assert logs.displays(clean).count() == 3
    assert logs.displays(clean, min_size=2).count() == 2


def test_each_text_is_parsed_once(spark):
    plan = logs.pages(logs.clean(logs.parse_logs(text(spark, "{}"))))._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("from_json(") == 1


def test_change_filters(spark, rows):
    records = changes(
        spark,
        [
            change("t", "insert", {"id": "1", "c": "b"}),
            change("t", "update", {"id": "2", "c": "b"}, {"c": "a"}),
            change("t", "update", {"id": "3", "c": "b"}, {"other": "a"}),
            change("t", "update", {"id": "4", "c": "b"}, None),
            change("t", "delete", {"id": "5"}, {"c": "a"}),
            change("t", "update", {"id": "6", "c": "b"}, {"c": "a"}, database="elsewhere"),
            change("u", "update", {"id": "7", "c": "b"}, {"c": "a"}),
        ],
    )
    updates = cdc.changes(records, "t", ("update",))
    assert rows(updates.where(cdc.changed("c")).select(*cdc.fields("id"))) == [("2",)]
    assert rows(updates.where(cdc.moved("c", "a", "b")).select(*cdc.fields("id"))) == [("2",)]
    assert updates.select(cdc.data("not_there").alias("x")).where("x is null").count() == 3


def test_cart_takes_new_rows_and_increases_only(spark, rows):
    def row(number, kind, new, old=None, has_old=True):
        return change(
            "cart_info", kind, {"id": number, "sku_num": new, "source_type": "2401"},
            {"sku_num": old} if has_old else None,
        )

    records = changes(
        spark,
        [
            row("new", "insert", "3", has_old=False),
            row("rises", "update", "10", "9"),
            row("equal", "update", "4", "4"),
            row("falls", "update", "4", "5"),
            row("no number", "update", "x", "1"),
            row("other column", "update", "4", has_old=False),
            change("cart_info", "insert", {"id": "no name", "sku_num": "1", "source_type": "2499"}),
        ],
    )
    out = trade_facts.cart_add(records, dictionary(spark, c2401="search"))
    assert rows(out, "id", "sku_num", "source_type_id", "source_type_name") == [
        ("new", "3", "2401", "search"), ("rises", "1", "2401", "search"),
    ]
    # by name: the code of the source type does not slip into another column
    assert out.columns[-3:] == ["source_type_id", "source_id", "source_type_name"]


def test_coupon_facts(spark, rows):
    at = "2024-01-01 10:00:00"
    records = changes(
        spark,
        [
            change("coupon_use", "insert", {"id": "1", "get_time": at}),
            change("coupon_use", "update", {"id": "2", "coupon_status": "1402", "using_time": at},
                   {"coupon_status": "1401"}),
            change("coupon_use", "update", {"id": "3", "coupon_status": "1402", "using_time": at},
                   {"coupon_status": "1400"}),
            change("coupon_use", "update", {"id": "4", "used_time": at}, {"used_time": None}),
            change("coupon_use", "update", {"id": "4", "used_time": at}, {"remark": "x"}),
        ],
    )
    assert rows(simple_facts.coupon_get(records), "id", "date_id") == [("1", "2024-01-01")]
    assert rows(simple_facts.coupon_order(records), "id", "order_time") == [("2", at)]
    # a later update of a used coupon counts again
    assert rows(simple_facts.coupon_pay(records), "id") == [("4",), ("4",)]


ROUTES = [
    {"op": "c", "ts_ms": 1, "after": {"source_table": "a", "sink_table": "dim_a",
                                      "sink_columns": "id,name", "sink_pk": None}},
    {"op": "u", "ts_ms": 2, "after": {"source_table": "a", "sink_table": "dim_a",
                                      "sink_columns": "id,name,x", "sink_pk": ""}},
    {"op": "c", "ts_ms": 1, "after": {"source_table": "b", "sink_table": "dim_b",
                                      "sink_columns": "code,name", "sink_pk": "code"}},
    {"op": "c", "ts_ms": 1, "after": {"source_table": "gone", "sink_table": "dim_gone",
                                      "sink_columns": "id"}},
    {"op": "d", "ts_ms": 2, "before": {"source_table": "gone"}, "after": None},
]


def routes(spark):
    return routing.current_routes(
        readers.route_changes(text(spark, *[json.dumps(r) for r in ROUTES]))
    )


def test_last_route_wins_and_deletion_removes(spark, rows):
    assert rows(routes(spark)) == [
        ("a", "dim_a", "id,name,x", "id"), ("b", "dim_b", "code,name", "code"),
    ]


def test_dimension_job_keeps_latest_per_configured_key(spark, rows):
    records = changes(
        spark,
        [
            change("a", "bootstrap-insert", {"id": "1", "name": "first", "y": "no"}, ts=1),
            change("a", "update", {"id": "1", "name": "second", "x": "x2"}, ts=5, xid=1),
            change("a", "update", {"id": "1", "name": "third", "x": None}, ts=5, xid=2),
            change("a", "update", {"id": "9", "name": "unseen"}, ts=2),
            change("a", "delete", {"id": "9"}, ts=9),
            change("b", "insert", {"code": "k", "id": "77", "name": "by code"}, ts=1),
            change("gone", "insert", {"id": "1"}, ts=1),
            change("unrouted", "insert", {"id": "1"}, ts=1),
        ],
    )
    routed = routing.route_dimensions(records, routes(spark))
    latest = routing.latest_dimensions(routed)
    assert rows(routing.dimension_table(latest, "dim_a", ["id", "name", "x"])) == [
        ("1", "third", None), ("9", "unseen", None),
    ]
    assert rows(routing.dimension_table(latest, "dim_b", ["code", "name"])) == [("k", "by code")]
    kept = routed.select(F.explode(F.map_keys("data")).alias("k")).distinct()
    assert rows(kept) == [("code",), ("id",), ("name",), ("x",)]


def test_empty_dimension_has_text_columns(spark):
    empty = routing.empty_dimension(spark, "id,name")
    assert [(f.name, f.dataType.simpleString()) for f in empty.schema] == [
        ("id", "string"), ("name", "string"),
    ]


def test_page_table_has_event_time(spark, rows):
    value = page_log(spark, [page(1, "m", "2024-01-01 00:00:01")]).select(
        F.to_json(F.struct("common", "page", "ts")).alias("value")
    )
    assert rows(readers.page_table(value).select(F.date_format("rt", "HH:mm:ss"))) == [("00:00:01",)]


def test_log_schema_covers_router_fields():
    assert set(schemas.LOG.fieldNames()) >= {"common", "page", "displays", "actions", "start", "err"}


@pytest.mark.parametrize("text,broken,ts,during", [
    ('{"page":{"during_time":"12"},"ts":5}', False, 5, 12),
    ('{"page":{"during_time":12},"ts":"1592270938000"}', False, 1592270938000, 12),
    ('{"page":{"during_time":1.0},"ts":1.0}', False, 1, 1),
    ('{"page":{"during_time":"x"},"ts":7}', False, 7, None),
    ('{"displays":{"item":"1"},"page":{"during_time":3},"ts":7}', False, 7, 3),
    (' {"ts":8} ', False, 8, None),
    ('{"ts":8} xyz', True, None, None),
    ('{"ts":8', True, None, None),
    ("[1]", True, None, None),
    ("null", True, None, None),
    ("", True, None, None),
    (None, True, None, None),
])
def test_only_the_text_makes_a_record_broken(spark, text, broken, ts, during):
    (r,) = logs.parse_logs(spark.createDataFrame([(text,)], "value string")).collect()
    assert (r._corrupt is not None) == broken
    if broken:
        assert r._corrupt == (text or "")
    else:
        assert (r.ts, r.page.during_time if r.page else None) == (ts, during)
        assert r.displays is None


def test_change_records_with_text_numbers_stay_and_broken_ones_go_to_their_own_output(spark):
    good = '{"database":"shop","table":"t","type":"insert","ts":"1592270938","xid":1.0,"data":{"id":"1"}}'
    raw = spark.createDataFrame([(good,), ("{bad",), (good + " x",)], "value string")
    clean, dirty = cdc.split_cdc(raw)
    assert [(r.ts, r.xid, r.data) for r in clean.collect()] == [(1592270938, 1, {"id": "1"})]
    assert sorted(r.value for r in dirty.collect()) == sorted(["{bad", good + " x"])
