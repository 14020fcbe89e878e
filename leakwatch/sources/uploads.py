"""Metadata of received uploads. Contents are hashed and dropped."""

from pyspark.sql import functions as F

from leakwatch.functions import fixed


def upload_metadata(requests, limit=fixed.MAX_UPLOAD_BYTES):
    """Requests up to the size limit with a short content hash and header fallbacks."""
    missing = F.lit("N/A")
    return requests.filter(F.col("content_length") <= limit).select(
        "request_id",
        "client_ip",
        "client_port",
        "content_length",
        F.substring(F.sha2(F.col("body").cast("binary"), 256), 1, 16).alias("content_sha"),
        F.coalesce("session_id", missing).alias("session_id"),
        F.coalesce("mode", missing).alias("mode"),
        F.coalesce("chunk_id", "seq", missing).alias("chunk_id"),
    )


def rejected_uploads(requests, limit=fixed.MAX_UPLOAD_BYTES):
    return requests.filter(F.col("content_length") > limit)
