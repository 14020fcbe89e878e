"""Literal rows and brute-force twins used by the tests."""

import random

from leakwatch.functions import schemas
from leakwatch.sources.packets import parse_packets

NORMAL = {
    "request_count": 20.0,
    "total_fwd_bytes": 5000.0,
    "total_bwd_bytes": 10000.0,
    "total_bytes": 15000.0,
    "upload_download_ratio": 0.5,
    "burst_count": 2.0,
    "burst_ratio": 0.1,
    "unusual_port_ratio": 0.0,
    "request_rate": 0.5,
    "inter_request_time_mean": 1.5,
    "inter_request_time_std": 0.5,
    "mean_payload_size": 250.0,
    "std_payload_size": 50.0,
    "psh_flag_count": 10.0,
    "ack_flag_count": 20.0,
    "syn_flag_count": 2.0,
    "window_duration": 40.0,
    "unique_destinations": 1.0,
}


def window_frame(spark, changes):
    """Windows of 60 s in the given order; each entry overrides the normal window."""
    rows = []
    for i, change in enumerate(changes):
        row = {"src_ip": "10.0.0.1", "window_start": 60.0 * i, "window_end": 60.0 * i + 60, **NORMAL}
        row.update({k: float(v) if not isinstance(v, str) else v for k, v in change.items()})
        rows.append(row)
    names = ["src_ip", "window_start", "window_end", *NORMAL]
    schema = ", ".join(f"{n} {'string' if n == 'src_ip' else 'double'}" for n in names)
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def random_packets(n, seed=7, span_us=120_000_000, hosts=2):
    """Raw packet tuples in which one host holds most rows and times repeat."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        host = 0 if rng.random() < 0.8 else rng.randrange(hosts)
        ts = rng.randrange(0, span_us, 50_000)
        up = rng.random() < 0.5
        client = 50_000 + rng.randrange(3)
        src, dst = (client, 443) if up else (443, client)
        ip, peer = f"10.0.0.{host}", f"203.0.113.{rng.randrange(4)}"
        size = rng.randrange(0, 1400)
        rows.append((i, ts, ip, peer, src, dst, size, size + 54, 6, rng.choice([2, 16, 18, 24, 17, 20])))
    return rows


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.RAW_PACKET)


def packet_frame(spark, rows):
    return parse_packets(raw_frame(spark, rows))


def rows_of(frame, *order):
    return [tuple(r) for r in frame.orderBy(*order).collect()]
