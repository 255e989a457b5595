"""Fixed schemas of the stored tables; nothing on the ingest path is inferred."""

from pyspark.sql import types as T

DATAPOINT = T.StructType(
    [
        T.StructField("time_stamp", T.LongType()),
        T.StructField("application", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("target_address", T.StringType()),
        T.StructField("target_attribute_id", T.LongType()),
        T.StructField("app_rsp_time", T.DoubleType()),
        T.StructField("byte_count", T.LongType()),
        T.StructField("flow_count", T.LongType()),
        T.StructField("rx_byte_count", T.LongType()),
        T.StructField("rx_flow_count", T.LongType()),
        T.StructField("tcp_rsp_time", T.DoubleType()),
        T.StructField("tx_byte_count", T.LongType()),
        T.StructField("tx_flow_count", T.LongType()),
    ]
)

ATTRIBUTE = T.StructType(
    [
        T.StructField("attribute_id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("target_address", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("time_stamp", T.LongType()),
    ]
)

# Both stored tables are laid out by the date and, within it, by the append that brought the rows.
PARTITION = T.StructField("event_date", T.DateType())
BATCH = T.StructField("batch", T.StringType())

# The times up to which a stored table is whole, one row for each finished append.
APPEND_LOG = T.StructType([T.StructField("time_stamp", T.LongType())])

ATTRIBUTE_COLUMNS = ("attribute_id", "source", "target_address", "location")

RUN_LOG = T.StructType(
    [
        T.StructField("report", T.StringType()),
        T.StructField("horizon", T.StringType()),
        T.StructField("run_time", T.DoubleType()),
        T.StructField("run_date", T.DateType()),
        *[T.StructField(f"{kind}_rows", T.LongType()) for kind in ("data", "forecast", "valid", "analyse")],
    ]
)


def stored(schema: T.StructType) -> T.StructType:
    """The schema of a table as it lies in the store."""
    return T.StructType(schema.fields + [PARTITION, BATCH])
