import numpy as np
import pytest

from helpers import packet_frame, random_packets, rows_of
from leakwatch.operators import flows

ROWS = random_packets(1200, seed=3)


def brute(rows):
    table = {}
    for r in sorted(rows, key=lambda r: (r[1], r[0])):
        key, back = (r[2], r[3], r[4], r[5]), (r[3], r[2], r[5], r[4])
        table.setdefault(back if back in table else key, []).append(r)
    out = {}
    for (src, dst, sport, dport), ps in table.items():
        if len(ps) < 2:
            continue
        fwd = [p for p in ps if (p[2], p[4]) == (src, sport)]
        bwd = [p for p in ps if (p[2], p[4]) == (dst, dport)]

        def gaps(part):
            return np.diff([p[1] for p in part]) if len(part) > 1 else np.array([0.0])

        lens = [p[7] for p in ps]
        out[f"{src}:{sport}→{dst}:{dport}"] = {
            "Total Fwd Packets": len(fwd), "Total Backward Packets": len(bwd), "n_packets": len(ps),
            "Flow Duration": max(ps[-1][1] - ps[0][1], 1), "Flow IAT Std": gaps(ps).std(), "Flow IAT Min": gaps(ps).min(),
            "Fwd IAT Mean": gaps(fwd).mean(), "Fwd IAT Std": gaps(fwd).std(), "Bwd IAT Max": gaps(bwd).max(),
            "Bwd IAT Total": gaps(bwd).sum(), "Idle Min": gaps(bwd).min(), "burst_count": int((gaps(ps) < 100_000).sum()),
            "Packet Length Std": np.std(lens), "Packet Length Variance": np.var(lens),
            "Init_Win_bytes_forward": fwd[0][7], "Init_Win_bytes_backward": bwd[0][7] if bwd else 0,
            "Bwd Packet Length Min": min([p[7] for p in bwd], default=0), "act_data_pkt_fwd": sum(p[6] > 0 for p in fwd),
            "Fwd PSH Flags": sum(p[9] & 8 > 0 for p in fwd), "RST Flag Count": sum(p[9] & 4 > 0 for p in ps),
        }
    return out


def check(frame, want):
    got = {r["Flow Key"]: r for r in frame.collect()}
    assert set(got) == set(want)
    for key, features in want.items():
        for name, value in features.items():
            assert got[key][name] == pytest.approx(value, rel=1e-9, abs=1e-6), (key, name)


def test_features_equal_brute_force(spark):
    check(flows.flow_features(packet_frame(spark, ROWS)), brute(ROWS))


def test_slices_of_any_length_give_the_same_rows(spark, monkeypatch):
    packets = packet_frame(spark, ROWS)
    for slice_us in (100_000, 7_000_000, 10**12):
        monkeypatch.setattr(flows, "SLICE_US", slice_us)
        check(flows.flow_features(packets), brute(ROWS))


def test_regular_beacons_have_no_spread(spark):
    """Gaps of an hour, where squares of microseconds no longer fit a double."""
    rows = [(i, i * 3_600_000_003, "a", "b", 5000, 80, 1, 55, 6, 16) for i in range(25)]
    out = flows.flow_features(packet_frame(spark, rows)).first()
    assert out["Flow IAT Std"] == 0.0 and out["Fwd IAT Std"] == 0.0 and out["Flow IAT Mean"] == 3_600_000_003.0


def test_one_sided_and_single_packet_flows(spark):
    rows = [(1, 0, "a", "b", 5000, 80, 1, 55, 6, 16), (2, 9, "a", "b", 5000, 80, 1, 55, 6, 16), (3, 5, "c", "b", 5000, 80, 1, 55, 6, 16)]
    out = flows.flow_features(packet_frame(spark, rows)).collect()
    assert len(out) == 1 and out[0]["Bwd IAT Mean"] == 0.0 and out[0]["Bwd Packet Length Max"] == 0
    assert out[0]["Flow Duration"] == 9.0


def test_orientation_is_that_of_the_first_packet(spark):
    rows = [(2, 10, "a", "b", 5000, 80, 1, 55, 6, 16), (1, 10, "b", "a", 80, 5000, 1, 60, 6, 16)]
    row = flows.assemble(packet_frame(spark, rows)).first()
    assert (row["src_ip"], row["src_port"], row["fwd_packets"]) == ("b", 80, 1)


def test_assembly_counts_every_packet(spark):
    out = rows_of(flows.assemble(packet_frame(spark, ROWS)).selectExpr("sum(fwd_packets + bwd_packets)"), 1)
    assert out == [(len(ROWS),)]
