"""Schemas of the messages and rows the pipeline reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

# Application log message: {common:{mid,uid,ar,ch,vc}, page:{page_id,last_page_id}, ts}
# ``event_id`` is the message id carried with every record (the topic offset
# plays that role on a broker); ``ts`` is epoch milliseconds, as a number or as
# text.
APP_LOG = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("common", T.StructType([
        T.StructField("mid", T.StringType()),
        T.StructField("uid", T.StringType()),
        T.StructField("ar", T.StringType()),
        T.StructField("ch", T.StringType()),
        T.StructField("vc", T.StringType()),
    ])),
    T.StructField("page", T.StructType([
        T.StructField("page_id", T.StringType()),
        T.StructField("last_page_id", T.StringType()),
    ])),
    T.StructField("ts", T.StringType()),
])

# One record of a topic: the payload, the broker timestamp, and its place.  A
# replay without places leaves them null.
TOPIC_RECORD = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

# Change-data envelope.  Row images are open maps of strings: change feeds
# quote every value, and the column set differs per table.
CDC_ENVELOPE = T.StructType([
    T.StructField("table", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("data", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    T.StructField("pkNames", T.ArrayType(T.StringType())),
])

# Fields of the order messages, in their order and spelling.
# (name, Spark SQL type, default when absent or unparsable).
# A default of None means the column stays null.
ORDER_INFO_FIELDS = [
    ("id", "bigint", 0),
    ("province_id", "bigint", 0),
    ("order_status", "string", None),
    ("user_id", "bigint", 0),
    ("total_amount", "double", 0.0),
    ("activity_reduce_amount", "double", 0.0),
    ("coupon_reduce_amount", "double", 0.0),
    ("original_total_amount", "double", 0.0),
    ("feight_fee", "double", 0.0),
    ("feight_fee_reduce", "double", 0.0),
    ("expire_time", "string", None),
    ("refundable_time", "string", None),
    ("create_time", "string", None),
    ("operate_time", "string", None),
]

ORDER_DETAIL_FIELDS = [
    ("id", "bigint", None),
    ("order_id", "bigint", None),
    ("sku_id", "bigint", None),
    ("order_price", "double", None),
    ("sku_num", "bigint", None),
    ("sku_name", "string", None),
    ("create_time", "string", None),
    ("split_total_amount", "double", 0.0),
    ("split_activity_amount", "double", 0.0),
    ("split_coupon_amount", "double", 0.0),
]

DAU_INFO_COLUMNS = ["mid", "uid", "ar", "ch", "vc", "dt", "hr", "ts"]

# Column order of the wide row: line columns, then order columns, then the
# dimension columns looked up for the order.
ORDER_WIDE_COLUMNS = [
    "detail_id", "order_id", "sku_id", "order_price", "sku_num", "sku_name",
    "split_total_amount", "split_activity_amount", "split_coupon_amount",
    "province_id", "order_status", "user_id", "total_amount",
    "activity_reduce_amount", "coupon_reduce_amount", "original_total_amount",
    "feight_fee", "feight_fee_reduce", "expire_time", "refundable_time",
    "create_time", "operate_time", "create_date", "create_hour",
    "province_name", "province_area_code", "province_3166_2_code",
    "province_iso_code", "user_age", "user_gender",
]

# Tables whose change records are dimension upserts; all
# others are facts.
DIM_TABLES = ("user_info", "sku_info", "base_province")
