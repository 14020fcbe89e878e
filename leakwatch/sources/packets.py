"""Packet tables: bounded scans, directory streams and the parse projection."""

from pyspark.sql import functions as F

from leakwatch.functions import columns as C
from leakwatch.functions import fixed, schemas


def read_packets(spark, path, fmt="parquet"):
    """Bounded input of stored packets."""
    return spark.read.schema(schemas.RAW_PACKET).format(fmt).load(path)


def stream_packets(spark, path, fmt="parquet", files_per_trigger=None):
    """Unbounded input: every file that lands in the directory is read once."""
    reader = spark.readStream.schema(schemas.RAW_PACKET).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def stream_topic(spark, servers, topic, options=None):
    """The same records as JSON values of a Kafka topic (needs the Kafka package)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**(options or {}))
        .load()
    )
    value = F.from_json(F.col("value").cast("string"), schemas.RAW_PACKET)
    return raw.select(value.alias("packet")).select("packet.*")


def protocol_name(proto):
    return (
        F.when(proto == 6, F.lit("TCP"))
        .when(proto == 17, F.lit("UDP"))
        .otherwise(F.format_string("proto-%d", proto))
    )


def parse_packets(raw):
    """Keep TCP and UDP, name the protocol and decode the flag byte.

    UDP packets carry the word UDP in place of a flag byte and no flag set.
    """
    udp = F.col("proto") == 17
    byte = F.when(~udp, F.col("flags"))
    return raw.filter(F.col("proto").isin(6, 17)).select(
        "packet_id",
        "ts_us",
        "src_ip",
        "dst_ip",
        "src_port",
        "dst_port",
        F.greatest(F.coalesce("payload_len", F.lit(0)), F.lit(0)).alias("payload_len"),
        "pkt_len",
        protocol_name(F.col("proto")).alias("protocol"),
        F.when(udp, F.lit("UDP")).otherwise(F.col("flags").cast("string")).alias("flags"),
        C.decode_flags(byte).alias("tcp_flags"),
        *[c for c in raw.columns if c not in schemas.RAW_PACKET.names],
    )


def http_only(packets, ports=None):
    """Either port is a web port."""
    return packets.filter(C.is_http(ports=ports))


def host_only(packets, host=None):
    """Either address is the host; no host lets everything pass."""
    if not host:
        return packets
    return packets.filter((F.col("src_ip") == host) | (F.col("dst_ip") == host))


def live_filter(packets, host=None, ports=None):
    """The narrower filter of a live capture: TCP only, web port, optional host."""
    return host_only(http_only(packets.filter(F.col("protocol") == "TCP"), ports), host)


def packet_line(packets):
    """One readable line per packet."""
    text = F.concat(
        C.fixed_text(F.col("ts_us") / 1e6, 3),
        F.lit("  "),
        F.concat_ws(":", "src_ip", F.col("src_port").cast("string")),
        F.lit(" → "),
        F.concat_ws(":", "dst_ip", F.col("dst_port").cast("string")),
        F.lit("  ["),
        F.col("protocol"),
        F.lit("]  len="),
        F.col("pkt_len").cast("string"),
        F.lit("  payload="),
        F.col("payload_len").cast("string"),
    )
    return packets.select("packet_id", text.alias("summary"))


def capture_counters(raw, http=True, host=None):
    """Seen, unparsed, skipped and kept packets in one pass."""
    parsed = F.col("proto").isin(6, 17)
    wanted = C.is_http() if http else F.lit(True)
    if host:
        wanted = wanted & ((F.col("src_ip") == host) | (F.col("dst_ip") == host))
    span = (F.max("ts_us") - F.min("ts_us")) / 1e6
    return raw.agg(
        F.count(F.lit(1)).alias("packets_seen"),
        F.count_if(parsed & wanted).alias("packets_queued"),
        F.count_if(parsed & ~wanted).alias("packets_skipped"),
        F.count_if(~parsed).alias("parse_errors"),
        C.safe_div(F.count(F.lit(1)), span).alias("packets_per_second"),
    )


def observed(packets, name="capture"):
    """Attach counters that a batch Observation or a streaming listener reads."""
    return packets.observe(
        name,
        F.count(F.lit(1)).alias("packets"),
        F.count_if(C.is_http()).alias("web_packets"),
        F.max("ts_us").alias("latest_us"),
    )
