"""Independent SQL for every registered query, over the same sample tables."""

from __future__ import annotations

FMT = "'%Y-%m-%d %H:%M:%S'"
DICTIONARY = """
base_dic AS (
  SELECT * FROM (VALUES ('2401','search'),('2402','promotion'),('2403','recommend'),
    ('1101','alipay'),('1102','wechat'),('1501','refund only'),('1502','return and refund'),
    ('1301','quality'),('1302','size'),('1303','other'),('1201','good'),('1202','fair'),
    ('1203','bad')) AS t(dic_code, dic_name))
"""

PAGE_LOG = """
page_log AS (
  SELECT e.event_id, e.event_type, epoch_us(e.ts) // 1000 AS ms, e.user_id,
    make_timestamp(epoch_us(e.ts) // 1000 * 1000) AS t,
    'mid_' || CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid,
    CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'signup' THEN 'login'
         WHEN 'purchase' THEN 'trade' ELSE 'good_list' END AS page_id,
    CASE WHEN event_id % 10 < 4 THEN NULL WHEN event_id % 10 = 4 THEN 'login'
         WHEN event_id % 10 IN (5, 6) THEN 'search' ELSE 'home' END AS last_page_id,
    CASE WHEN event_id % 10 IN (5, 6) THEN 'keyword' ELSE 'sku_id' END AS item_type,
    CASE WHEN event_id % 10 IN (5, 6) THEN p.p_name ELSE CAST(event_id % 200 AS VARCHAR) END AS item,
    CAST(floor(value * 10) AS BIGINT) AS during_time,
    'v2.1.' || CAST(event_id % 3 AS VARCHAR) AS vc,
    CASE user_id % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'Appstore' ELSE 'xiaomi' END AS ch,
    CAST(user_id % 25 AS VARCHAR) AS ar,
    CASE WHEN event_id % 7 = 0 THEN '1' ELSE '0' END AS is_new
  FROM events e LEFT JOIN part p ON p.p_partkey = e.event_id // 5),
raw_log AS (
  SELECT *, '{"ar":"' || ar || '","ch":"' || ch || '","is_new":"' || is_new || '","mid":"' || mid
    || '","uid":"' || uid || '","vc":"' || vc || '"}' AS common
  FROM page_log WHERE event_id % 97 <> 0 AND event_id % 89 <> 0)
"""

ORDERS = """
order_info AS (
  SELECT o_orderkey AS id, o_custkey AS user_id, c_nationkey AS province_id,
    CAST(o_totalprice AS DECIMAL(16,2)) AS total_amount,
    o_orderdate + to_seconds(o_orderkey % 86400) AS create_time, o_orderstatus AS st,
    CASE WHEN o_orderstatus = 'O' THEN '1001'
         WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN '1003'
         WHEN o_orderstatus = 'F' AND o_orderpriority = '2-HIGH' THEN '1005'
         WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN '1006' ELSE '1002' END AS new_status,
    CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE '1001' END AS old_status
  FROM orders JOIN customer ON c_custkey = o_custkey),
detail_raw AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS order_id, l_partkey AS sku_id,
    CAST(l_quantity AS INTEGER) AS sku_num, CAST(l_extendedprice AS DECIMAL(16,2)) AS order_price,
    CASE WHEN l_returnflag = 'A' THEN CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,4)) END AS split_activity_amount,
    CASE WHEN l_returnflag = 'R' THEN CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(16,4)) END AS split_coupon_amount,
    CAST(CAST(l_extendedprice AS DECIMAL(16,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(16,4)) AS split_total_amount,
    CAST(2401 + l_suppkey % 4 AS VARCHAR) AS source_type, l_returnflag AS rf, l_shipdate AS row_op_ts,
    l_shipdate + to_seconds(l_orderkey % 86400) AS create_time,
    l_suppkey, l_linestatus, l_tax, l_discount
  FROM lineitem),
detail AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY row_op_ts DESC, sku_id DESC,
    l_suppkey DESC, sku_num DESC, order_price DESC, l_discount DESC, l_tax DESC, rf DESC,
    l_linestatus DESC) AS rn FROM detail_raw) WHERE rn = 1),
rows_raw AS (
  SELECT CAST(d.id AS VARCHAR) AS id, CAST(d.order_id AS VARCHAR) AS order_id,
    CAST(sku_id AS VARCHAR) AS sku_id, CAST(sku_num AS VARCHAR) AS sku_num,
    CAST(order_price AS VARCHAR) AS order_price, split_activity_amount, split_coupon_amount,
    split_total_amount, CAST(split_activity_amount AS VARCHAR) AS act_txt,
    CAST(split_coupon_amount AS VARCHAR) AS coup_txt, CAST(split_total_amount AS VARCHAR) AS tot_txt,
    CAST(o.user_id AS VARCHAR) AS user_id, CAST(o.province_id AS VARCHAR) AS province_id,
    d.create_time AS t, row_op_ts
  FROM detail_raw d JOIN order_info o ON o.id = d.order_id),
rows_latest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY row_op_ts DESC, sku_id DESC,
    sku_num DESC, order_price DESC, tot_txt DESC, act_txt DESC NULLS LAST, coup_txt DESC NULLS LAST) AS rn
    FROM rows_raw) WHERE rn = 1),
rows_first AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY row_op_ts, sku_id,
    sku_num, order_price, tot_txt, act_txt NULLS LAST, coup_txt NULLS LAST) AS rn
    FROM rows_raw) WHERE rn = 1)
"""

FIRST_AFTER_IDLE = """
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, row_op_ts
  ORDER BY id, sku_id, sku_num, order_price, tot_txt, act_txt NULLS LAST, coup_txt NULLS LAST) AS n FROM rows_raw),
g AS (SELECT *, lag(row_op_ts) OVER (PARTITION BY user_id ORDER BY row_op_ts) AS before FROM r WHERE n = 1)
"""

DIMS = """
spu AS (SELECT DISTINCT CAST(p_partkey % 50 AS VARCHAR) AS id, 'spu_' || CAST(p_partkey % 50 AS VARCHAR) AS spu_name
        FROM part WHERE p_partkey % 50 < 40),
tm AS (SELECT DISTINCT p_brand AS id, upper(p_brand) AS tm_name FROM part),
c3 AS (SELECT DISTINCT p_type AS id, 'c3 ' || p_type AS name, CAST(length(p_type) % 3 AS VARCHAR) AS category2_id FROM part),
c2 AS (SELECT DISTINCT category2_id AS id, 'c2 ' || category2_id AS name,
              CAST(CAST(category2_id AS INTEGER) % 2 AS VARCHAR) AS category1_id FROM c3),
c1 AS (SELECT DISTINCT category1_id AS id, 'c1 ' || category1_id AS name FROM c2)
"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts) + "\n"


def bounds(time: str, interval: str) -> str:
    """Start and end text of the window that holds ``time``."""
    start = f"time_bucket(INTERVAL '{interval}', {time})"
    return (
        f"strftime({start}, {FMT}) AS stt, "
        f"strftime({start} + INTERVAL '{interval}', {FMT}) AS edt"
    )


LOG = _with(PAGE_LOG)
TRADE = _with(DICTIONARY, ORDERS)


def keyword_window(interval):
    return LOG + f"""
    SELECT stt, edt, 'search' AS source, keyword, count(*) AS keyword_count FROM (
      SELECT {bounds('t', interval)},
        unnest(regexp_extract_all(lower(item), '[\\p{{L}}\\p{{N}}]+')) AS keyword
      FROM page_log WHERE last_page_id = 'search' AND item_type = 'keyword' AND item IS NOT NULL)
    GROUP BY ALL"""


def _jumps(within_ms):
    return f"""
    jumps AS (
      SELECT * FROM (SELECT *, lead(ms) OVER w AS next_ms, lead(last_page_id) OVER w AS next_last
        FROM page_log WINDOW w AS (PARTITION BY mid ORDER BY ms, event_id))
      WHERE last_page_id IS NULL
        AND (next_ms IS NULL OR next_ms - ms >= {within_ms} OR next_last IS NULL))"""


VISITORS = """
visitors AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mid, CAST(t AS DATE) ORDER BY ms, event_id) AS rn
    FROM page_log) WHERE rn = 1)"""


def user_jump(within_ms):
    return _with(PAGE_LOG, _jumps(within_ms)) + """
    SELECT event_id, mid, page_id, last_page_id, ms AS ts FROM jumps"""


def _measures(within_ms):
    return _with(PAGE_LOG, VISITORS, _jumps(within_ms)) + """, measures AS (
      SELECT t, vc, ch, ar, is_new, 1 AS uv, 0 AS sv, 0 AS pv, 0 AS dur, 0 AS uj FROM visitors
      UNION ALL SELECT t, vc, ch, ar, is_new, 0, 0, 0, 0, 1 FROM jumps
      UNION ALL SELECT t, vc, ch, ar, is_new, 0, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END, 1,
        coalesce(during_time, 0), 0 FROM page_log)"""


_SUMS = """CAST(sum(uv) AS BIGINT) AS uv_ct, CAST(sum(sv) AS BIGINT) AS sv_ct,
  CAST(sum(pv) AS BIGINT) AS pv_ct, CAST(sum(dur) AS BIGINT) AS dur_sum, CAST(sum(uj) AS BIGINT) AS uj_ct"""


def traffic_dims_window(interval, within_ms):
    return _measures(within_ms) + f"""
    SELECT {bounds('t', interval)}, vc, ch, ar, is_new, {_SUMS}
    FROM measures GROUP BY ALL"""


def union_measures(within_ms):
    return _measures(within_ms) + f"""
    SELECT vc, ch, ar, is_new, {_SUMS} FROM measures GROUP BY ALL"""


def page_uv_window(interval):
    return LOG + f"""
    SELECT {bounds('t', interval)},
      CAST(sum(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END) AS BIGINT) AS home_uv_ct,
      CAST(sum(CASE WHEN page_id = 'good_detail' THEN 1 ELSE 0 END) AS BIGINT) AS good_detail_uv_ct
    FROM (SELECT t, page_id, row_number() OVER (PARTITION BY mid, page_id, CAST(t AS DATE) ORDER BY ms, event_id) AS rn
          FROM page_log WHERE page_id IN ('home', 'good_detail'))
    WHERE rn = 1 GROUP BY ALL"""


def user_login_window(interval, gap):
    return LOG + f""", flags AS (
      SELECT event_id, CAST(t AS DATE) AS d,
        lag(CAST(t AS DATE)) OVER (PARTITION BY uid ORDER BY ms, event_id) AS prev
      FROM page_log WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login'))
    SELECT {bounds('t', interval)},
      CAST(sum(CASE WHEN date_diff('day', prev, d) > {gap} THEN 1 ELSE 0 END) AS BIGINT) AS back_ct,
      CAST(sum(CASE WHEN d IS NOT NULL AND (prev IS NULL OR prev <> d) THEN 1 ELSE 0 END) AS BIGINT) AS uu_ct
    FROM page_log LEFT JOIN flags USING (event_id) WHERE uid IS NOT NULL GROUP BY ALL"""


def user_register_window(interval):
    return f"""SELECT {bounds("date_trunc('second', ts)", interval)}, count(*) AS register_ct
    FROM events WHERE event_type = 'signup' GROUP BY ALL"""


CART = _with(DICTIONARY) + f""", cart AS (
  SELECT event_id AS id, user_id, event_id % 200 AS sku_id, CAST(value AS DECIMAL(16,2)) AS cart_price,
    CASE WHEN event_id % 2 = 0 THEN event_id % 7 + 1 ELSE (event_id % 7 + 1) - (event_id % 5 + 1) END AS sku_num,
    date_trunc('second', ts) AS create_time,
    CASE WHEN event_id % 2 = 1 THEN date_trunc('second', ts) + INTERVAL 30 MINUTE END AS operate_time,
    CAST(2401 + event_id % 4 AS VARCHAR) AS source_type_id, event_id % 50 AS source_id, dic_name
  FROM events JOIN base_dic ON dic_code = CAST(2401 + event_id % 4 AS VARCHAR)
  WHERE event_type = 'click' AND (event_id % 2 = 0
    OR (event_id % 11 <> 0 AND event_id % 7 + 1 > event_id % 5 + 1)))"""

CART_ADD = CART + f"""
SELECT CAST(id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, CAST(sku_id AS VARCHAR) AS sku_id,
  CAST(cart_price AS VARCHAR) AS cart_price, CAST(sku_num AS VARCHAR) AS sku_num,
  'sku_' || CAST(sku_id AS VARCHAR) AS sku_name, '1' AS is_checked,
  strftime(create_time, {FMT}) AS create_time, strftime(operate_time, {FMT}) AS operate_time,
  '0' AS is_ordered, CAST(NULL AS VARCHAR) AS order_time, source_type_id,
  CAST(source_id AS VARCHAR) AS source_id, dic_name AS source_type_name
FROM cart"""


def cart_uu_window(interval):
    return CART + f"""
    SELECT {bounds('t', interval)}, count(*) AS cart_add_uu_ct FROM (
      SELECT coalesce(operate_time, create_time) AS t, row_number() OVER (
        PARTITION BY user_id, CAST(coalesce(operate_time, create_time) AS DATE)
        ORDER BY coalesce(operate_time, create_time), id) AS rn FROM cart)
    WHERE rn = 1 GROUP BY ALL"""


_WIDE = TRADE + f""", order_versions AS (
  SELECT id, user_id, province_id, total_amount, '1001' AS order_status, 'insert' AS type,
    CAST(NULL AS VARCHAR) AS old_status, CAST(NULL AS TIMESTAMP) AS operate_time, create_time AS commit_time
  FROM order_info
  UNION ALL
  SELECT id, user_id, province_id, total_amount, new_status, 'update', old_status,
    create_time + INTERVAL 10 MINUTE, create_time + INTERVAL 10 MINUTE FROM order_info WHERE st <> 'O'),
wide AS (
  SELECT d.*, 'sku_' || CAST(sku_id AS VARCHAR) AS sku_name, dic_name, o.user_id, o.province_id, o.total_amount,
    o.order_status, o.type, o.old_status, o.operate_time, o.commit_time, greatest(d.create_time, o.commit_time) AS version
  FROM detail d JOIN base_dic ON dic_code = source_type JOIN order_versions o ON o.id = d.order_id)"""

_POSITION = """CAST(id AS VARCHAR) AS id, CAST(order_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS user_id,
  CAST(sku_id AS VARCHAR) AS sku_id, sku_name, CAST(sku_num AS VARCHAR) AS sku_num,
  CAST(order_price AS VARCHAR) AS order_price, CAST(province_id AS VARCHAR) AS province_id,
  CASE WHEN rf = 'A' THEN CAST(id % 10 AS VARCHAR) END AS activity_id,
  CASE WHEN rf = 'A' THEN CAST(id % 20 AS VARCHAR) END AS activity_rule_id,
  CASE WHEN rf = 'R' THEN CAST(id % 7 AS VARCHAR) END AS coupon_id,
  CAST(l_suppkey AS VARCHAR) AS source_id, source_type AS source_type_id, dic_name AS source_type_name,
  CAST(split_activity_amount AS VARCHAR) AS split_activity_amount,
  CAST(split_coupon_amount AS VARCHAR) AS split_coupon_amount,
  CAST(split_total_amount AS VARCHAR) AS split_total_amount"""

ORDER_WIDE = _WIDE + f"""
SELECT {_POSITION}, source_type, strftime(create_time, {FMT}) AS create_time,
  CAST(total_amount AS VARCHAR) AS total_amount, order_status, strftime(operate_time, {FMT}) AS operate_time,
  CASE WHEN rf = 'A' THEN CAST(id AS VARCHAR) END AS order_detail_activity_id,
  CASE WHEN rf = 'R' THEN CAST(id AS VARCHAR) END AS order_detail_coupon_id,
  CASE WHEN rf = 'R' THEN CAST(id % 70 AS VARCHAR) END AS coupon_use_id,
  type, old_status, strftime(version, {FMT}) AS row_op_ts
FROM wide"""

ORDER_DETAIL = _WIDE + f"""
SELECT {_POSITION}, strftime(create_time, {FMT}) AS create_time, strftime(version, {FMT}) AS row_op_ts
FROM wide WHERE type = 'insert'"""

ORDER_CANCEL = _WIDE + f"""
SELECT {_POSITION}, strftime(operate_time, {FMT}) AS cancel_time
FROM wide WHERE type = 'update' AND old_status IS NOT NULL AND order_status = '1003'"""

ORDER_REFUND = TRADE + f"""
SELECT CAST(d.id AS VARCHAR) AS id, CAST(o.user_id AS VARCHAR) AS user_id, CAST(order_id AS VARCHAR) AS order_id,
  CAST(sku_id AS VARCHAR) AS sku_id, CAST(o.province_id AS VARCHAR) AS province_id,
  t.dic_code AS refund_type, t.dic_name AS type_dic_name, CAST(sku_num AS VARCHAR) AS refund_num,
  CAST(split_total_amount AS VARCHAR) AS refund_amount, r.dic_code AS refund_reason_type,
  r.dic_name AS reason_dic_name, 'reason ' || CAST(d.id % 10 AS VARCHAR) AS refund_reason_txt,
  '0701' AS refund_status, strftime(o.create_time, {FMT}) AS create_time
FROM detail d JOIN order_info o ON o.id = d.order_id
JOIN base_dic t ON t.dic_code = CAST(1501 + d.id % 2 AS VARCHAR)
JOIN base_dic r ON r.dic_code = CAST(1301 + d.id % 3 AS VARCHAR)
WHERE o.new_status = '1005' AND o.old_status IS NOT NULL"""

PAY_DETAIL = _WIDE + f"""
SELECT CAST(w.id AS VARCHAR) AS order_detail_id, CAST(order_id AS VARCHAR) AS order_id,
  CAST(w.user_id AS VARCHAR) AS user_id, CAST(sku_id AS VARCHAR) AS sku_id, sku_name,
  CAST(w.province_id AS VARCHAR) AS province_id,
  CASE WHEN rf = 'A' THEN CAST(w.id % 10 AS VARCHAR) END AS activity_id,
  CASE WHEN rf = 'A' THEN CAST(w.id % 20 AS VARCHAR) END AS activity_rule_id,
  CASE WHEN rf = 'R' THEN CAST(w.id % 7 AS VARCHAR) END AS coupon_id,
  p.dic_code AS payment_type_code, p.dic_name AS payment_type_name,
  strftime(o.create_time + INTERVAL 10 MINUTE, {FMT}) AS callback_time,
  CAST(l_suppkey AS VARCHAR) AS source_id, source_type AS source_type_id, w.dic_name AS source_type_name,
  CAST(sku_num AS VARCHAR) AS sku_num, CAST(split_activity_amount AS VARCHAR) AS split_activity_amount,
  CAST(split_coupon_amount AS VARCHAR) AS split_coupon_amount,
  CAST(split_total_amount AS VARCHAR) AS split_payment_amount, strftime(version, {FMT}) AS row_op_ts
FROM wide w JOIN order_info o ON o.id = w.order_id AND o.st = 'P'
JOIN base_dic p ON p.dic_code = CAST(1101 + o.id % 3 AS VARCHAR) WHERE w.type = 'insert'"""


def refund_detail(by_sku):
    on = "AND i.sku_id = d.sku_id" if by_sku else ""
    return TRADE + f"""
    SELECT CAST(d.id AS VARCHAR) AS id, 'out_' || CAST(d.id AS VARCHAR) AS out_trade_no,
      CAST(d.order_id AS VARCHAR) AS order_id, CAST(d.sku_id AS VARCHAR) AS sku_id, dic_code AS payment_type,
      dic_name AS payment_name, 'trade_' || CAST(d.id AS VARCHAR) AS trade_no,
      CAST(d.split_total_amount AS VARCHAR) AS total_amount, 'refund' AS subject, '0705' AS refund_status,
      strftime(o.create_time, {FMT}) AS create_time,
      strftime(o.create_time + INTERVAL 10 MINUTE, {FMT}) AS callback_time, 'ok' AS callback_content,
      CAST(o.user_id AS VARCHAR) AS user_id, CAST(o.province_id AS VARCHAR) AS province_id,
      CAST(i.sku_num AS VARCHAR) AS refund_num
    FROM detail d JOIN order_info o ON o.id = d.order_id JOIN detail i ON i.order_id = d.order_id {on}
    JOIN base_dic ON dic_code = CAST(1101 + d.id % 3 AS VARCHAR)
    WHERE o.new_status = '1006' AND o.old_status IS NOT NULL"""


_DAY = "strftime(ts, '%Y-%m-%d')"
_AT = f"strftime(ts, {FMT})"


def _event_fact(columns, where):
    return f"SELECT {columns} FROM events WHERE {where}"


COUPON_GET = _event_fact(
    "CAST(event_id AS VARCHAR) AS id, CAST(event_id % 20 AS VARCHAR) AS coupon_id, "
    f"CAST(user_id AS VARCHAR) AS user_id, {_DAY} AS date_id, {_AT} AS get_time",
    "event_type = 'purchase' AND event_id % 3 = 0",
)
_COUPON = (
    "CAST(event_id AS VARCHAR) AS id, CAST(event_id % 20 AS VARCHAR) AS coupon_id, "
    "CAST(user_id AS VARCHAR) AS user_id, CAST(event_id * 3 AS VARCHAR) AS order_id, "
)
COUPON_ORDER = _event_fact(
    _COUPON + f"{_DAY} AS date_id, {_AT} AS order_time",
    "event_type = 'purchase' AND event_id % 3 = 1 AND event_id % 5 <> 0",
)
COUPON_PAY = _event_fact(
    _COUPON + f"{_DAY} AS date_id, {_AT} AS payment_time",
    "event_type = 'purchase' AND event_id % 3 = 2",
)
FAVOR_ADD = _event_fact(
    "CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id, "
    f"CAST(event_id % 200 AS VARCHAR) AS sku_id, {_DAY} AS date_id, {_AT} AS create_time",
    "event_type = 'view'",
)
COMMENT_ADD = _with(DICTIONARY) + f"""
SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
  CAST(event_id % 200 AS VARCHAR) AS sku_id, CAST(event_id * 3 AS VARCHAR) AS order_id, {_DAY} AS date_id,
  {_AT} AS create_time, dic_code AS appraise_code, dic_name AS appraise_name
FROM events JOIN base_dic ON dic_code = CAST(1201 + event_id % 4 AS VARCHAR) WHERE event_type = 'error'"""
USER_REGISTER = _event_fact(
    f"CAST(event_id AS VARCHAR) AS user_id, {_DAY} AS date_id, {_AT} AS create_time",
    "event_type = 'signup'",
)


def payment_window(interval):
    return TRADE + f""", paid AS (
      SELECT o.user_id, o.create_time + INTERVAL 10 MINUTE AS t
      FROM order_info o JOIN base_dic ON dic_code = CAST(1101 + o.id % 3 AS VARCHAR)
      WHERE o.st = 'P' AND EXISTS (SELECT 1 FROM detail_raw d WHERE d.order_id = o.id)),
    firsts AS (
      SELECT user_id, CAST(t AS DATE) AS d, min(t) AS t FROM paid GROUP BY ALL)
    SELECT {bounds('t', interval)}, count(*) AS unique_users,
      CAST(sum(CASE WHEN d = first_day THEN 1 ELSE 0 END) AS BIGINT) AS new_users
    FROM (SELECT *, min(d) OVER (PARTITION BY user_id) AS first_day FROM firsts) GROUP BY stt, edt"""


def order_window(interval):
    return TRADE + f""", flagged AS (
      SELECT *, lag(CAST(t AS DATE)) OVER (PARTITION BY user_id ORDER BY t, id) AS prev FROM rows_latest)
    SELECT {bounds('t', interval)},
      CAST(sum(CASE WHEN prev IS NULL OR prev <> CAST(t AS DATE) THEN 1 ELSE 0 END) AS BIGINT) AS unique_users,
      CAST(sum(CASE WHEN prev IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS new_users,
      CAST(sum(coalesce(split_activity_amount, 0)) AS DOUBLE) AS activity_reduce,
      CAST(sum(coalesce(split_coupon_amount, 0)) AS DOUBLE) AS coupon_reduce,
      CAST(sum(CAST(sku_num AS INTEGER) * CAST(order_price AS DECIMAL(18,4))) AS DOUBLE) AS original_total
    FROM flagged GROUP BY stt, edt"""


def province_order_window(interval):
    return TRADE + f"""
    SELECT stt, edt, province_id, n_name AS province_name, order_count, order_amount FROM (
      SELECT {bounds('t', interval)}, province_id, count(DISTINCT order_id) AS order_count,
        CAST(sum(split_total_amount) AS DOUBLE) AS order_amount
      FROM rows_latest GROUP BY stt, edt, province_id)
    LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = province_id"""


def user_spu_order_window(interval):
    return _with(DICTIONARY, ORDERS, DIMS) + f""", counted AS (
      SELECT {bounds('t', interval)}, user_id, CAST(p_partkey % 50 AS VARCHAR) AS spu_id,
        p_brand AS trademark_id, p_type AS category3_id, count(DISTINCT order_id) AS order_count,
        CAST(sum(split_total_amount) AS DOUBLE) AS order_amount
      FROM rows_first LEFT JOIN part ON CAST(p_partkey AS VARCHAR) = sku_id
      GROUP BY stt, edt, user_id, spu_id, trademark_id, category3_id)
    SELECT stt, edt, trademark_id, tm_name AS trademark_name, c2.category1_id, c1.name AS category1_name,
      c3.category2_id, c2.name AS category2_name, category3_id, c3.name AS category3_name, user_id, spu_id,
      spu_name, order_count, order_amount
    FROM counted LEFT JOIN spu ON spu.id = spu_id LEFT JOIN tm ON tm.id = trademark_id
    LEFT JOIN c3 ON c3.id = category3_id LEFT JOIN c2 ON c2.id = c3.category2_id
    LEFT JOIN c1 ON c1.id = c2.category1_id"""


_PROJECT = "event_id, mid, page_id, last_page_id, ms AS ts"

CHANGE_KINDS = """
  SELECT 'cart_info' AS tbl, CASE WHEN event_id % 2 = 0 THEN 'insert' ELSE 'update' END AS type, event_id AS xid, user_id,
    CASE WHEN event_id % 2 = 1 AND event_id % 11 <> 0 THEN CAST(event_id % 5 + 1 AS VARCHAR) END AS old_num
  FROM events WHERE event_type = 'click'"""

ORACLE = {
    # logs
    "log_dirty_split": LOG + """
      SELECT event_id, event_id % 97 = 0 OR event_id % 89 = 0 AS is_dirty,
        CASE WHEN event_id % 97 = 0 THEN 'cut' WHEN event_id % 89 = 0 THEN 'more text' END AS fault,
        CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 0 THEN ms END AS ts,
        CASE WHEN event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 13 <> 0 THEN during_time END AS during_time
      FROM page_log""",
    "log_route_error": LOG + """
      SELECT event_id, common, '{"error_code":' || CAST(event_id % 500 AS VARCHAR) || ',"msg":"failed"}' AS err, ms AS ts
      FROM raw_log WHERE event_type = 'error'""",
    "log_route_start": LOG + """
      SELECT event_id, common, '{"entry":"icon","loading_time":' || CAST(event_id % 900 AS VARCHAR) || '}' AS start, ms AS ts
      FROM raw_log WHERE event_id % 13 = 0""",
    "log_route_page": LOG + """
      SELECT event_id, mid, uid, vc, ch, ar, is_new, page_id, last_page_id, item, item_type, during_time, ms AS ts
      FROM raw_log WHERE event_id % 13 <> 0""",
    "log_explode_displays": LOG + """
      SELECT event_id, common, page_id, i - 1 AS pos, 'query' AS display_type, CAST((event_id + i) % 200 AS VARCHAR) AS item,
        'sku_id' AS item_type, i AS "order", i % 5 AS pos_id, ms AS ts
      FROM (SELECT *, unnest(range(1, event_id % 3 + 1)) AS i FROM raw_log WHERE event_id % 13 <> 0 AND event_id % 101 <> 0)""",
    "log_explode_displays_min2": LOG + """
      SELECT event_id, common, page_id, i - 1 AS pos, 'query' AS display_type, CAST((event_id + i) % 200 AS VARCHAR) AS item,
        'sku_id' AS item_type, i AS "order", i % 5 AS pos_id, ms AS ts
      FROM (SELECT *, unnest(range(1, event_id % 3 + 1)) AS i FROM raw_log WHERE event_id % 13 <> 0 AND event_id % 101 <> 0 AND event_id % 3 > 1)""",
    "log_explode_actions": LOG + """
      SELECT event_id, common, page_id, i - 1 AS pos, 'favor_add' AS action_id, CAST((event_id + i) % 200 AS VARCHAR) AS item,
        'sku_id' AS item_type, ms + i AS ts
      FROM (SELECT *, unnest(range(1, event_id % 4 + 1)) AS i FROM raw_log WHERE event_id % 13 <> 0)""",
    # traffic
    "daily_first": _with(PAGE_LOG, VISITORS) + f"SELECT {_PROJECT} FROM visitors",
    "traffic_unique_visitor": _with(PAGE_LOG, VISITORS)
    + f"SELECT {_PROJECT}, vc, ch, ar, is_new FROM visitors",
    "traffic_user_jump": user_jump(21_600_000),
    "traffic_user_jump_10s": user_jump(10_000),
    "keyword_window": keyword_window("10 seconds"),
    "keyword_window_1d": keyword_window("1 day"),
    "page_uv_window": page_uv_window("10 seconds"),
    "page_uv_window_1d": page_uv_window("1 day"),
    "union_measures": union_measures(21_600_000),
    "traffic_dims_window": traffic_dims_window("10 seconds", 10_000),
    "traffic_dims_window_1d": traffic_dims_window("1 day", 21_600_000),
    "explode_tokens": """
      SELECT word, count(*) AS n FROM (
        SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS word FROM documents)
      GROUP BY word""",
    # users
    "user_login_window": user_login_window("10 seconds", 8),
    "user_login_window_1d": user_login_window("1 day", 2),
    "user_register_window": user_register_window("10 seconds"),
    "user_register_window_1d": user_register_window("1 day"),
    "cart_uu_window": cart_uu_window("10 seconds"),
    "cart_uu_window_1d": cart_uu_window("1 day"),
    "first_ever": LOG + f"""
      SELECT {_PROJECT} FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY ms, event_id) AS rn FROM page_log)
      WHERE rn = 1""",
    # change records
    "cdc_envelope": f"""
      SELECT 'cart_info' AS "table", type, count(*) AS n, CAST(sum(xid) AS BIGINT) AS xid_sum,
        CAST(sum(user_id) AS BIGINT) AS user_sum, count(old_num) AS with_old FROM ({CHANGE_KINDS}) GROUP BY ALL
      UNION ALL SELECT 'favor_info', 'insert', count(*), CAST(sum(event_id) AS BIGINT),
        CAST(sum(user_id) AS BIGINT), 0 FROM events WHERE event_type = 'view'""",
    "cdc_filter_map": f"""
      SELECT CAST(event_id AS VARCHAR) AS id, CAST(user_id AS VARCHAR) AS user_id,
        CAST(event_id % 200 AS VARCHAR) AS sku_id, {_AT} AS create_time, CAST(NULL AS VARCHAR) AS not_there
      FROM events WHERE event_type = 'view'""",
    "cdc_changed_column": f"SELECT xid, old_num AS old_sku_num FROM ({CHANGE_KINDS}) WHERE old_num IS NOT NULL",
    "cdc_debezium_after": """
      SELECT 'base_province' AS source_table, 'dim_base_province' AS sink_table, 'id,name,area_code' AS sink_columns,
        'id' AS sink_pk, count(*) AS changes FROM nation
      UNION ALL SELECT 'sku_info', 'dim_sku_info', 'id,sku_name,tm_id,category3_id,price', 'id',
        CAST(sum(1 + (CASE WHEN p_size > 25 THEN 1 ELSE 0 END) + (CASE WHEN p_size > 45 THEN 1 ELSE 0 END)) AS BIGINT) FROM part
      UNION ALL SELECT 'customer_info', 'dim_customer_info', 'id,name,province_id', 'id', count(*) FROM customer""",
    "dim_route_by_config": """
      SELECT 'dim_base_province' AS sink_table, 'bootstrap-insert' AS type, CAST(n_nationkey AS VARCHAR) AS pk FROM nation
      UNION ALL SELECT 'dim_sku_info', 'bootstrap-insert', CAST(p_partkey AS VARCHAR) FROM part
      UNION ALL SELECT 'dim_sku_info', 'update', CAST(p_partkey AS VARCHAR) FROM part WHERE p_size > 25
      UNION ALL SELECT 'dim_customer_info', 'insert', CAST(c_custkey AS VARCHAR) FROM customer""",
    "dim_project_columns": """
      SELECT 'dim_base_province' AS sink_table, CAST(n_nationkey AS VARCHAR) AS pk, 'area_code,id,name' AS kept FROM nation
      UNION ALL SELECT 'dim_sku_info', CAST(p_partkey AS VARCHAR), 'category3_id,id,price,sku_name,tm_id' FROM part
      UNION ALL SELECT 'dim_sku_info', CAST(p_partkey AS VARCHAR), 'category3_id,id,price,sku_name,tm_id' FROM part WHERE p_size > 25
      UNION ALL SELECT 'dim_customer_info', CAST(c_custkey AS VARCHAR), 'id,name,province_id' FROM customer""",
    "dim_upsert_latest": """
      SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS sku_name, p_brand AS tm_id, p_type AS category3_id,
        CASE WHEN p_size > 25 THEN CAST(CAST(p_retailprice * 2 AS DECIMAL(16,2)) AS VARCHAR)
             ELSE CAST(CAST(p_retailprice AS DECIMAL(16,2)) AS VARCHAR) END AS price
      FROM part""",
    "lookup_join_inner": _with(DICTIONARY, ORDERS) + """
      SELECT dic_name AS source_type_name, count(*) AS n, CAST(sum(split_total_amount) AS DOUBLE) AS amount
      FROM detail_raw JOIN base_dic ON dic_code = source_type GROUP BY ALL""",
    "lookup_join_left": _with(DIMS) + """
      SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS VARCHAR) AS line, spu_name
      FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
      LEFT JOIN spu ON spu.id = CAST(p_partkey % 50 AS VARCHAR)""",
    # facts
    "trade_cart_add": CART_ADD,
    "trade_order_wide": ORDER_WIDE,
    "trade_order_detail": ORDER_DETAIL,
    "trade_order_cancel": ORDER_CANCEL,
    "trade_order_refund": ORDER_REFUND,
    "trade_pay_detail": PAY_DETAIL,
    "trade_refund_detail": refund_detail(False),
    "trade_refund_detail_by_sku": refund_detail(True),
    "coupon_get": COUPON_GET,
    "coupon_order": COUPON_ORDER,
    "coupon_pay": COUPON_PAY,
    "favor_add": FAVOR_ADD,
    "comment_add": COMMENT_ADD,
    "user_register": USER_REGISTER,
    # keyed state and windows
    "dedup_latest": TRADE + f"""
      SELECT id, order_id, sku_id, sku_num, order_price, tot_txt AS split_total_amount,
        strftime(row_op_ts, {FMT}) AS row_op_ts FROM rows_latest""",
    "dedup_first": TRADE + f"""
      SELECT id, order_id, sku_id, sku_num, order_price, tot_txt AS split_total_amount,
        strftime(row_op_ts, {FMT}) AS row_op_ts FROM rows_first""",
    "tumble_global": f"""
      SELECT {bounds('ts', '10 seconds')}, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(16,2))) AS DOUBLE) AS value_sum
      FROM events GROUP BY ALL""",
    "tumble_keyed": f"""
      SELECT {bounds('ts', '1 day')}, event_type, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(16,2))) AS DOUBLE) AS value_sum
      FROM events GROUP BY ALL""",
    "window_distinct_count": f"""
      SELECT {bounds('ts', '1 day')}, event_type, count(DISTINCT user_id) AS users FROM events GROUP BY ALL""",
    "payment_window": payment_window("10 seconds"),
    "payment_window_1d": payment_window("1 day"),
    "order_window": order_window("10 seconds"),
    "order_window_1d": order_window("1 day"),
    "province_order_window": province_order_window("10 seconds"),
    "province_order_window_1d": province_order_window("1 day"),
    "user_spu_order_window": user_spu_order_window("10 seconds"),
    "user_spu_order_window_1d": user_spu_order_window("1 day"),
    # streams
    "src_stream": LOG + f"""
      SELECT mid, page_id, last_page_id, item, ms AS ts, strftime(t, {FMT}) AS rt FROM page_log""",
    "sink_append": CART_ADD,
    "log_route_stream": LOG + """
      SELECT 'dirty' AS output, count(*) AS n FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0
      UNION ALL SELECT 'error', count(*) FROM raw_log WHERE event_type = 'error'
      UNION ALL SELECT 'start', count(*) FROM raw_log WHERE event_id % 13 = 0
      UNION ALL SELECT 'display', CAST(sum(event_id % 3) AS BIGINT) FROM raw_log WHERE event_id % 13 <> 0 AND event_id % 101 <> 0
      UNION ALL SELECT 'action', CAST(sum(event_id % 4) AS BIGINT) FROM raw_log WHERE event_id % 13 <> 0
      UNION ALL SELECT 'page', count(*) FROM raw_log WHERE event_id % 13 <> 0""",
    "first_after_idle": _with(DICTIONARY, ORDERS, FIRST_AFTER_IDLE) + f"""
      SELECT user_id, id, order_id, sku_id, sku_num, order_price, tot_txt AS split_total_amount,
        strftime(row_op_ts, {FMT}) AS row_op_ts FROM g
      WHERE before IS NULL OR row_op_ts - before > INTERVAL 30 DAY""",
}
# streams get rows far in the future, so they give what the batch forms give, to the last row
ORACLE |= {
    f"{name}_stream": ORACLE[name]
    for name in (
        "traffic_unique_visitor", "traffic_user_jump", "keyword_window", "page_uv_window", "cart_uu_window",
        "window_distinct_count", "traffic_dims_window", "dedup_first", "dedup_latest", "first_after_idle",
        "payment_window", "order_window", "province_order_window", "user_spu_order_window",
    )
}
ORACLE["user_login_window_stream"] = ORACLE["user_login_window_1d"]
# stream joins keep rows for longer than the tables span, so they give what the batch joins give
ORACLE |= {
    "trade_order_wide_stream": ORDER_WIDE,
    "trade_order_refund_stream": ORDER_REFUND,
    "trade_refund_detail_stream": refund_detail(True),
    "trade_pay_detail_stream": PAY_DETAIL,
}
ORACLE["sink_upsert"] = ORACLE["dim_upsert_latest"]

_S = "epoch_ms(date_trunc('second', ts)) // 1000"
_ROUTED = f"""
  WITH r AS (
    SELECT 'cart_info' AS tbl, CASE WHEN event_id % 2 = 0 THEN 'insert' ELSE 'update' END AS type, event_id, user_id,
      {_S} + (CASE WHEN event_id % 2 = 0 THEN 0 ELSE 1800 END) AS s FROM events WHERE event_type = 'click'
    UNION ALL SELECT 'favor_info', 'insert', event_id, user_id, {_S} FROM events WHERE event_type = 'view'),
  t AS (SELECT *, make_timestamp(s * 1000000) AS t FROM r),
  routed AS (
    SELECT 'dim_cart' AS sink_table, type, CAST(event_id AS VARCHAR) AS pk, CAST(s AS BIGINT) AS ts, event_id AS xid, 'id,user_id' AS kept
    FROM t WHERE tbl = 'cart_info' AND t >= '2024-01-05' AND t < '2024-01-15 12:00:00'
    UNION ALL SELECT 'dim_cart_goods', type, CAST(event_id AS VARCHAR), CAST(s AS BIGINT), event_id, 'id,sku_id,sku_num'
    FROM t WHERE tbl = 'cart_info' AND t >= '2024-01-15 12:00:00' AND t < '2024-01-22'
    UNION ALL SELECT 'dim_cart', type, CAST(user_id AS VARCHAR), CAST(s AS BIGINT), event_id, 'id,sku_num,user_id'
    FROM t WHERE tbl = 'cart_info' AND t >= '2024-01-26'
    UNION ALL SELECT 'dim_favor', type, CAST(event_id AS VARCHAR), CAST(s AS BIGINT), event_id, 'id,sku_id'
    FROM t WHERE tbl = 'favor_info' AND t >= '2024-01-10 12:00:00')"""
_CUSTOMERS = """
  SELECT CAST(c_custkey AS VARCHAR) AS pk, CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS name,
    CAST(c_nationkey AS VARCHAR) AS province_id FROM customer WHERE c_custkey % 11 <> 0 AND c_custkey % 7 <> 0
  UNION ALL SELECT CAST(c_custkey + 1000000 AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_custkey % 5 = 0"""
_DETAIL_ACTIVITY = TRADE + """
  SELECT CAST(id AS VARCHAR) AS id, CAST(order_id AS VARCHAR) AS order_id,
    CASE WHEN rf = 'A' THEN CAST(id AS VARCHAR) END AS detail_id,
    CASE WHEN rf = 'A' THEN CAST(id % 10 AS VARCHAR) END AS activity_id,
    CASE WHEN rf = 'A' THEN CAST(id % 20 AS VARCHAR) END AS activity_rule_id FROM detail"""
ORACLE |= {
    "route_by_time": _ROUTED + " SELECT * FROM routed",
    "route_by_time_stream": _ROUTED + """
      SELECT sink_table, type, pk, ts, xid, kept FROM (
        SELECT *, row_number() OVER (PARTITION BY sink_table, pk ORDER BY ts DESC, xid DESC) AS rn FROM routed) WHERE rn = 1""",
    "as_of_join": """
      WITH p AS (SELECT user_id, epoch_ms(ts) AS ms, max(event_id) AS purchase_id FROM events WHERE event_type = 'purchase' GROUP BY ALL),
      v AS (SELECT event_id, user_id, epoch_ms(ts) AS ms FROM events WHERE event_type = 'view')
      SELECT event_id, purchase_id FROM v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ms >= p.ms""",
    "snapshot_then_changes": _CUSTOMERS,
    "snapshot_then_changes_stream": _CUSTOMERS,
    "trade_detail_activity": _DETAIL_ACTIVITY,
    "trade_detail_activity_changes_stream": _DETAIL_ACTIVITY,
    "trade_pay_detail_from_feed": PAY_DETAIL,
    "payment_window_resumed_stream": payment_window("10 seconds"),
}
ORACLE["window_distinct_sketch"] = f"SELECT *, true AS near FROM ({ORACLE['window_distinct_count']})"
ORACLE["trade_cart_add_refreshed_stream"] = CART_ADD
