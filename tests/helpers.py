"""Small hand-written inputs."""

from datetime import datetime, timezone

from millrace import schemas

LOG_SCHEMA = (
    "event_id bigint, common struct<mid:string, uid:string, vc:string, ch:string, ar:string, "
    "is_new:string>, page struct<page_id:string, last_page_id:string, item:string, "
    "item_type:string, during_time:bigint>, ts bigint"
)


def ms(text):
    """Milliseconds of a UTC time such as ``2024-01-01 10:00:00.500``."""
    return round(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp() * 1000)


def page(event_id, mid, time, last="home", page_id="home", uid=None, item=None,
         item_type="sku_id", during=5):
    return (
        event_id, (mid, uid, "v1", "web", "1", "0"),
        (page_id, last, item, item_type, during), ms(time),
    )


def page_log(spark, pages):
    return spark.createDataFrame(pages, LOG_SCHEMA)


def change(table, kind, data, old=None, ts=0, xid=0, database="shop"):
    return (database, table, kind, ts, xid, data, old)


def changes(spark, records):
    return spark.createDataFrame(records, schemas.CDC)


def dictionary(spark, **names):
    return spark.createDataFrame(
        [(k.lstrip("c"), v) for k, v in names.items()], "dic_code string, dic_name string"
    )
