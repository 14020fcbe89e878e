import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import packet_frame, random_packets, raw_frame, rows_of
from leakwatch.functions import fixed, schemas
from leakwatch.operators import windows
from leakwatch.session import fresh_dir
from leakwatch.sources import packets as P
from leakwatch.streaming import run
from leakwatch.streaming import windows as stream_windows


def forward(flags, src, dst):
    syn, ack = flags & 2, flags & 16
    if syn:
        return not ack
    if flags & 5:
        return True
    return src > 49152 or not dst > 49152


def brute(rows, seconds=60):
    """Window features by plain loops over sorted packets."""
    groups = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        groups.setdefault((r[2], r[1] // (seconds * 1_000_000)), []).append(r)
    out = {}
    for (ip, bucket), ps in groups.items():
        if len(ps) < 3:
            continue
        fwd = [forward(p[9], p[4], p[5]) for p in ps]
        gaps = np.diff([p[1] for p in ps]) / 1e6
        led = gaps[np.array(fwd[:-1])]
        up = sum(p[6] for p, f in zip(ps, fwd) if f)
        down = sum(p[6] for p, f in zip(ps, fwd) if not f)
        out[(ip, bucket * float(seconds))] = {
            "request_count": len(ps), "total_fwd_bytes": up, "total_bwd_bytes": down,
            "upload_download_ratio": up / max(down, 1),
            "burst_count": int((led < 0.1).sum()), "burst_ratio": (led < 0.1).sum() / max(len(led), 1),
            "unusual_port_ratio": np.mean([p[4] > 0 and p[4] not in fixed.SERVICE_PORTS for p in ps]),
            "inter_request_time_mean": gaps.mean(), "inter_request_time_std": gaps.std(),
            "inter_request_time_min": gaps.min(), "inter_request_time_max": gaps.max(),
            "request_rate": len(ps) / max((ps[-1][1] - ps[0][1]) / 1e6, 0.001),
            "std_payload_size": np.std([p[6] for p in ps]), "mean_packet_size": np.mean([p[7] for p in ps]),
            "unique_destinations": len({p[3] for p in ps}), "syn_flag_count": sum(p[9] & 2 > 0 for p in ps),
        }
    return out


def check(frame, want):
    got = {(r["src_ip"], r["window_start"]): r for r in frame.collect()}
    assert set(got) == set(want)
    for key, features in want.items():
        for name, value in features.items():
            assert got[key][name] == pytest.approx(value, abs=1e-9), (key, name)


ROWS = random_packets(1500)


def test_features_equal_brute_force(spark):
    check(windows.window_features(packet_frame(spark, ROWS)), brute(ROWS))


def test_slices_of_any_length_give_the_same_rows(spark, monkeypatch):
    """One host holds most rows; a bucket is cut into one, a few or very many slices."""
    packets = packet_frame(spark, ROWS)
    for slices in (1, 7, 600):
        monkeypatch.setattr(windows, "SLICES", slices)
        check(windows.window_features(packets), brute(ROWS))
    check(windows.window_features(packets, ordered=False), brute(ROWS))


def test_regular_gaps_have_no_spread(spark):
    rows = [(i, i * 2_500_003, "10.0.0.9", "1.1.1.1", 50000, 80, 10, 64, 6, 16) for i in range(24)]
    out = windows.window_features(packet_frame(spark, rows)).collect()
    assert [r["inter_request_time_std"] for r in out] == [0.0]


def test_one_instant_may_hold_many_packets(spark):
    rows = [(i, 5_000_000 if i < 200 else 5_000_000 + i, *r[2:]) for i, r in enumerate(ROWS[:260])]
    check(windows.window_features(packet_frame(spark, rows)), brute(rows))


def test_small_windows_are_dropped(spark):
    rows = [(i, i * 1000, "10.0.0.9", "1.1.1.1", 50000, 80, 10, 64, 6, 16) for i in range(2)]
    assert windows.window_features(packet_frame(spark, rows)).count() == 0
    counters = windows.window_counters(packet_frame(spark, rows)).first()
    assert (counters["windows_created"], counters["windows_skipped"]) == (0, 1)


def test_start_modes(spark):
    rows = [(i, 70_000_000 + i * 1_000_000, "10.0.0.9", "1.1.1.1", 50000, 80, 10, 64, 6, 16) for i in range(4)]
    bucket = windows.window_features(packet_frame(spark, rows)).first()
    first = windows.window_features(packet_frame(spark, rows), start="first_packet").first()
    assert (bucket["window_start"], bucket["window_duration"]) == (60.0, 13.0)
    assert (first["window_start"], first["window_duration"], first["window_end"]) == (70.0, 3.0, 120.0)


def test_vector_replaces_what_is_not_finite(spark):
    frame = spark.createDataFrame([(float("nan"), float("inf"), None)], "request_count double, total_bytes double, burst_ratio double")
    vector = frame.select(windows.runtime_vector(frame).alias("v")).first()["v"]
    assert vector == [0.0] * 17


def test_udp_has_no_flags(spark):
    rows = [(1, 0, "a", "b", 5, 6, 7, 8, 17, None), (2, 0, "a", "b", 5, 6, 7, 8, 1, None), (3, 0, "a", "b", 5, 6, -7, 8, 6, 18)]
    out = {r["packet_id"]: r for r in packet_frame(spark, rows).collect()}
    assert set(out) == {1, 3}
    assert out[1]["flags"] == "UDP" and not any(out[1]["tcp_flags"])
    assert out[3]["tcp_flags"]["SYN"] and out[3]["tcp_flags"]["ACK"] and out[3]["payload_len"] == 0


@pytest.mark.parametrize("flags,src,dst,want", [
    (2, 80, 80, "fwd"), (18, 50000, 80, "bwd"), (17, 80, 50000, "fwd"), (4, 80, 50000, "fwd"),
    (16, 50000, 80, "fwd"), (16, 80, 50000, "bwd"), (16, 80, 80, "fwd"), (16, 49152, 49153, "bwd"),
])
def test_direction_rules(spark, flags, src, dst, want):
    from leakwatch.functions import columns as C

    frame = packet_frame(spark, [(1, 0, "a", "b", src, dst, 1, 1, 6, flags)])
    assert frame.select(C.direction().alias("d")).first()["d"] == want


def test_observed_counters(spark):
    from pyspark.sql import Observation

    seen = Observation("capture")
    packets = packet_frame(spark, ROWS)
    packets.observe(seen, F.count(F.lit(1)).alias("packets")).count()
    assert seen.get["packets"] == len(ROWS)
    assert P.observed(packets).count() == len(ROWS)


def test_stream_equals_batch_and_counts_late_rows(spark):
    """Three arrivals in order, a far-off packet, then packets behind the watermark."""
    folder, out = fresh_dir(spark, "landing"), fresh_dir(spark, "windows")
    ordered = sorted(ROWS, key=lambda r: r[1])
    third = len(ordered) // 3
    closing = (-1, 10_000_000_000, "0.0.0.0", "0.0.0.0", 0, 0, 0, 0, 6, 0)
    parts = [ordered[:third], ordered[third : 2 * third], ordered[2 * third :], [closing], [(9999, 1, *ROWS[0][2:])]]
    for part in parts:
        raw_frame(spark, part).coalesce(1).write.mode("append").parquet(folder)
    stream = P.parse_packets(P.stream_packets(spark, folder, files_per_trigger=1))
    features = stream_windows.window_features(stream, slice_seconds=5, late="30 seconds")
    with run.rocksdb_state(spark):
        query = run.finish(run.to_table(features, out, fresh_dir(spark, "check")))
    assert run.late_rows(query) >= 1 and run.throughput(query)
    check(spark.read.parquet(out), brute(ROWS))


def test_stream_slices_must_divide(spark):
    with pytest.raises(ValueError):
        stream_windows.window_features(packet_frame(spark, ROWS), slice_seconds=7)


def test_schema_is_kept(spark, sf):
    folder = fresh_dir(spark, "stored")
    raw_frame(spark, ROWS[:10]).write.json(folder)
    assert P.read_packets(spark, folder, "json").schema == schemas.RAW_PACKET
    assert P.read_packets(spark, folder, "json").count() == 10
