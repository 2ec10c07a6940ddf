"""Record schemas. Field names, order and types are the wire contract."""

from pyspark.sql import types as T

CLICK = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("view_time", T.LongType()),
    T.StructField("page_url", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("ts", T.LongType()),
])

SHOE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("sale_price", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("rating", T.DoubleType()),
])

ENRICHED_CLICK = T.StructType(CLICK.fields + [T.StructField("product_name", T.StringType())])

# A log record as the Kafka source delivers it.
RECORD = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# Topic names the jobs read and write by default.
CLICK_TOPIC = "shoestore_clickstream"
SHOE_TOPIC = "shoestore_shoe"
ENRICHED_TOPIC = "shoestore_clickstream_enriched"
VIEWS_TOPIC = "shoestore_clickstream_product_views"
COUNTER_TOPIC = "my_counter"
RETAINED_TOPIC = "my_test_with_custom_retention"
