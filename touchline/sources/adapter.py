"""Driver ``events`` table -> nested raw web-analytics events.

The driver table is flat ``(event_id, ts, user_id, event_type, value,
props)``.  This projection maps it deterministically onto the nested raw
event layout the staging model reads, so every model runs on the given
data and grows with it.  It is a narrow projection: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions.params import param

# Fixed values of the mapping (adapter rule table).
EVENT_NAME_MAP = [
    ("view", "page_view"),
    ("click", "add_to_cart"),
    ("signup", "begin_checkout"),
    ("purchase", "purchase"),
    ("error", "session_start"),
]

# k % 10 -> (source, medium, campaign): every channel rule has a bucket;
# bucket 9 has no traffic source.
TRAFFIC_BUCKETS = [
    ("google shopping", "ppc", "autumn_range"),
    ("google maps", "organic", None),
    ("facebook feed", "paid", "come_back"),
    ("(direct)", "(none)", None),
    ("weekly letter", "email", "digest_12"),
    ("instagram", "profile", None),
    ("partner.example", "referral", None),
    ("aff.example", "affiliate", None),
    ("othersearch", "organic", None),
    (None, None, None),
]

# k % 3 -> (category, operating_system, browser)
DEVICE_BUCKETS = [
    ("mobile", "iOS", "Safari"),
    ("desktop", "Windows", "Chrome"),
    ("tablet", "Android", "Chrome"),
]

# user_id % 4 -> (country, region, city)
GEO_BUCKETS = [
    ("NO", "Vestland", "Bergen"),
    ("NO", "Agder", "Arendal"),
    ("PT", "Norte", "Braga"),
    ("FI", "Uusimaa", "Espoo"),
]

SESSION_SPAN_MICROS = 43_200_000_000  # two sessions per UTC day


def _pick(index: Column, options: list) -> Column:
    """``options[index]`` over a small fixed list (a constant array lookup,
    which keeps generated code small)."""
    return F.get(F.array(*[F.lit(v).cast("string") for v in options]), index.cast("int"))


def _param(key: str, string_value=None, int_value=None) -> Column:
    return F.struct(
        F.lit(key).alias("key"),
        F.struct(
            (string_value if string_value is not None else F.lit(None).cast("string")).alias("string_value"),
            (int_value if int_value is not None else F.lit(None).cast("bigint")).alias("int_value"),
            F.lit(None).cast("double").alias("float_value"),
        ).alias("value"),
    )


def raw_events_from_driver(events: DataFrame) -> DataFrame:
    """Map the driver ``events`` table onto the raw nested event layout."""
    k = F.regexp_extract("props", r"[0-9]+", 0).try_cast("int")
    ts = F.col("ts").cast("timestamp")
    micros = F.unix_micros(ts)
    name_map = F.create_map(*[F.lit(x) for pair in EVENT_NAME_MAP for x in pair])
    event_name = name_map[F.col("event_type")]
    session_id = F.floor(micros / F.lit(SESSION_SPAN_MICROS)).cast("bigint")

    base = events.select(
        F.col("event_id").alias("_src_event_id"),
        ts.alias("_ts"),
        micros.alias("event_timestamp"),
        F.col("user_id").alias("_uid"),
        event_name.alias("event_name"),
        F.col("value").alias("_value"),
        k.alias("_k"),
        session_id.alias("_sid"),
    )
    is_purchase = F.col("event_name") == "purchase"
    # The "value" param is present on every event; only checkouts carry a number.
    params = F.array(
        _param("ga_session_id", int_value=F.col("_sid")),
        _param("ga_session_number", int_value=(F.lit(1) + F.col("_sid") % 5).cast("bigint")),
        _param("page_location", string_value=F.concat(F.lit("https://shop.example/"), F.col("event_name"))),
        _param("engagement_time_msec", int_value=(F.lit(1000) + F.col("_k") * 100).cast("bigint")),
        _param("session_engaged", string_value=F.when(F.col("_k") % 2 == 0, "1").otherwise("0")),
        _param("value", int_value=F.when(F.col("event_name") == "begin_checkout",
                                         F.floor("_value").cast("bigint"))),
    )

    b = F.col("_k") % 10
    d = F.col("_k") % 3
    g = F.col("_uid") % 4
    return base.select(
        F.date_format("_ts", "yyyyMMdd").alias("event_date"),
        "event_timestamp",
        "event_name",
        F.col("_uid").cast("string").alias("user_pseudo_id"),
        F.lit(None).cast("string").alias("user_id"),
        params.alias("event_params"),
        F.struct(
            _pick(b, [t[0] for t in TRAFFIC_BUCKETS]).cast("string").alias("source"),
            _pick(b, [t[1] for t in TRAFFIC_BUCKETS]).cast("string").alias("medium"),
            _pick(b, [t[2] for t in TRAFFIC_BUCKETS]).cast("string").alias("name"),
        ).alias("traffic_source"),
        F.struct(
            _pick(d, [t[0] for t in DEVICE_BUCKETS]).alias("category"),
            _pick(d, [t[1] for t in DEVICE_BUCKETS]).alias("operating_system"),
            F.struct(_pick(d, [t[2] for t in DEVICE_BUCKETS]).alias("browser")).alias("web_info"),
        ).alias("device"),
        F.struct(
            _pick(g, [t[0] for t in GEO_BUCKETS]).alias("country"),
            _pick(g, [t[1] for t in GEO_BUCKETS]).alias("region"),
            _pick(g, [t[2] for t in GEO_BUCKETS]).alias("city"),
        ).alias("geo"),
        # Per-field CASE (not a CASE around the struct) so a reader of one
        # field is simplified to that field and prunes the others' inputs.
        F.struct(
            F.when(is_purchase, F.concat(F.lit("T"), F.col("_src_event_id").cast("string"))).alias("transaction_id"),
            F.when(is_purchase, F.col("_value")).alias("purchase_revenue"),
            F.when(is_purchase, (F.lit(1) + F.col("_k") % 3).cast("bigint")).alias("total_item_quantity"),
        ).alias("ecommerce"),
        F.lit("WEB").alias("platform"),
        F.lit("adapter-web").alias("stream_id"),
    )


# k -> (accounts are shared by so many neighbouring devices, prefix): events with which a login comes.
LOGINS = {11: (3, "p"), 57: (5, "q"), 83: (2, "r")}
KIOSK_LOGIN = 99  # one account of all devices


def with_logins(raw: DataFrame) -> DataFrame:
    """Raw events of which some carry the account (``user_id``) that was signed in on the device."""
    uid = F.col("user_pseudo_id").cast("bigint")
    k = (param("engagement_time_msec") - 1000) / 100
    account = F.when(k == KIOSK_LOGIN, "kiosk")
    for at, (devices, prefix) in LOGINS.items():
        account = account.when(k == at, F.concat(F.lit(prefix), F.floor(uid / devices).cast("string")))
    return raw.withColumn("user_id", account)
