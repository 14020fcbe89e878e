"""Explicit schemas of the record types."""

from pyspark.sql import types as T

from leakwatch.functions import fixed

TCP_FLAGS = T.StructType(
    [T.StructField(name, T.BooleanType(), True) for name in fixed.TCP_FLAG_BITS]
)

# A packet as it lies in storage: `flags` is the TCP flag byte, null for UDP.
RAW_PACKET = T.StructType(
    [
        T.StructField("packet_id", T.LongType()),
        T.StructField("ts_us", T.LongType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("dst_ip", T.StringType()),
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("payload_len", T.IntegerType()),
        T.StructField("pkt_len", T.IntegerType()),
        T.StructField("proto", T.IntegerType()),
        T.StructField("flags", T.IntegerType()),
    ]
)

PACKET = T.StructType(
    RAW_PACKET.fields[:8]
    + [
        T.StructField("protocol", T.StringType()),
        T.StructField("flags", T.StringType()),
        T.StructField("tcp_flags", TCP_FLAGS),
    ]
)

SCORE = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("label", T.IntegerType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("split", T.StringType()),
    ]
)
