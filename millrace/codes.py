"""Fixed values of the source systems: status codes, change types, intervals."""

# --- fixed values -----------------------------------------------------------
ORDER_CANCELLED = "1003"
ORDER_REFUND_ASKED = "1005"
ORDER_REFUNDED = "1006"
PAYMENT_PAID = "1602"
REFUND_DONE = "0705"
COUPON_GOT = "1401"
COUPON_IN_ORDER = "1402"

INSERT = "insert"
UPDATE = "update"
DELETE = "delete"
BOOTSTRAP_INSERT = "bootstrap-insert"

PAGE_HOME = "home"
PAGE_GOOD_DETAIL = "good_detail"
PAGE_LOGIN = "login"
PAGE_SEARCH = "search"
ITEM_KEYWORD = "keyword"

WINDOW_SIZE = "10 seconds"
WATERMARK = "2 seconds"
TRAFFIC_WATERMARK = "14 seconds"
BOUNCE_WITHIN_MS = 10_000
RETURN_GAP_DAYS = 8
DEDUP_DELAY_MS = 5000
DETAIL_RETENTION = "5 seconds"
DETAIL_IDLE_MS = 5000
DISORDER_MS = 2000
JOIN_RETENTION = "905 seconds"
JOIN_KEEP_MS = 905_000
#: Groups of keys whose state is kept together; fixed by the first start of a stream.
STATE_BUCKETS = 1024
#: A key that stays in state for less than this has a state of its own.
BUCKET_IDLE_MS = 60_000

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
# ---------------------------------------------------------------------------

DEFAULT_DATABASE = "shop"
