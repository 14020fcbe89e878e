import gzip
import os
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import random_packets, raw_frame
from leakwatch.plans import capture_queries
from leakwatch.session import fresh_dir, shared_root
from leakwatch.sources import capture_format as form
from leakwatch.sources import capture_sink, captures


@pytest.fixture()
def folder(tmp_path):
    return str(tmp_path)


def write(folder, **files):
    for name, data in files.items():
        with open(f"{folder}/{name.replace('__', '.')}", "wb") as out:
            out.write(data)


def capture_bytes(rows, nested=None, longest=262_144):
    """A little-endian capture; `nested` is put into the payload of every packet."""
    data = struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, longest, 1)
    for r in rows:
        body = nested or bytes(r[6])
        ip = struct.pack(">BBHHHBBH4B4B", 0x45, 0, min(40 + len(body), 65_535), 0, 0, 64, r[8], 0, 10, 0, 0, 1, 203, 0, 113, 5)
        tcp = struct.pack(">HHIIBBHHH", r[4], r[5], 0, 0, 0x50, r[9], 0, 0, 0)
        frame = bytes(12) + b"\x08\x00" + ip + tcp + body
        data += struct.pack("<IIII", r[1] // 1_000_000 + 1_700_000_000, r[1] % 1_000_000, len(frame), len(frame)) + frame
    return data


@pytest.mark.parametrize("chunk", [700, 5000, 10**9])
def test_capture_chunks_give_every_packet_once(spark, folder, chunk):
    rows = sorted(random_packets(120), key=lambda r: r[1])
    with open(f"{folder}/x.pcap", "wb") as out:
        out.write(capture_bytes(rows))
    got = captures.read_captures(spark, folder, chunk).orderBy("packet_id").collect()
    assert [(r["ts_us"] - 1_700_000_000_000_000, r["src_port"], r["dst_port"], r["payload_len"], r["flags"]) for r in got] == [
        (r[1], r[4], r[5], r[6], r[9]) for r in rows]
    assert len({r["packet_id"] for r in got}) == len(rows)


def test_captures_inside_captures_do_not_mislead(spark, folder):
    """Payloads that look like capture records: wrong guesses must be corrected."""
    rows = sorted(random_packets(60), key=lambda r: r[1])
    inner = capture_bytes([(*r[:6], 20, *r[7:]) for r in rows[:12]])[24:]
    with open(f"{folder}/x.pcap", "wb") as out:
        out.write(capture_bytes(rows, inner))
    got = captures.read_captures(spark, folder, 3000)
    assert got.count() == 60 and {r["payload_len"] for r in got.collect()} == {len(inner)}


def summary(spark, folder, chunk=10**6):
    rows = captures.Captures(spark, folder, chunk).summary().collect()
    return {r["capture_path"].rsplit("/", 1)[1]: tuple(r)[1:] for r in rows}


@pytest.mark.parametrize("chunk", [150, 10**6])
def test_unusable_files_are_reported(spark, folder, chunk):
    rows = sorted(random_packets(10), key=lambda r: r[1])
    whole = capture_bytes(rows)
    broken = whole + struct.pack("<IIII", 1, 1, 5_000_000, 5_000_000) + bytes(90)
    write(folder, cut__pcap=whole[:-7], junk__pcap=b"not a capture" * 30, head__pcap=whole[:24], half__pcap=whole[:9],
          none__pcap=b"", broken__pcap=broken, zip__pcap__gz=gzip.compress(whole), cutzip__pcap__gz=gzip.compress(whole, 0)[:-400],
          other__txt=whole, odd__cap=gzip.compress(whole[:-7]))
    got = summary(spark, folder, chunk)
    assert set(got) == {"cut.pcap", "junk.pcap", "head.pcap", "half.pcap", "none.pcap", "broken.pcap", "zip.pcap.gz", "cutzip.pcap.gz", "odd.cap"}
    last = len(capture_bytes(rows[-1:])) - 24
    assert got["cut.pcap"] == ("pcap", len(whole) - 7, 9, 9, 0, last - 7, "truncated")
    assert got["junk.pcap"] == ("foreign", 390, 0, 0, 0, 390, "foreign")
    assert got["head.pcap"] == ("pcap", 24, 0, 0, 0, 0, None)
    assert got["half.pcap"] == ("pcap", 9, 0, 0, 0, 9, "truncated")
    assert got["none.pcap"] == ("empty", 0, 0, 0, 0, 0, "empty")
    assert got["broken.pcap"] == ("pcap", len(broken), 10, 10, 0, 106, "damaged")
    assert got["zip.pcap.gz"][0] == "pcap.gz" and got["zip.pcap.gz"][2:] == (10, 10, 0, 0, None)
    assert got["odd.cap"][0] == "pcap.gz" and got["odd.cap"][2:] == (9, 9, 0, last - 7, "truncated")
    assert got["cutzip.pcap.gz"][5] == "truncated" or got["cutzip.pcap.gz"][6] == "truncated"
    assert 0 < got["cutzip.pcap.gz"][2] < 10


@pytest.mark.parametrize("chunk", [4_000, 70_000, 10**7])
def test_long_records_need_no_more_jobs(spark, folder, chunk):
    """Records far longer than a chunk, and longer than any real packet, with zeros inside."""
    body = bytes(400_000)
    rows = sorted(random_packets(9), key=lambda r: r[1])
    write(folder, x__pcap=capture_bytes([rows[0]], body, 1 << 20) + capture_bytes(rows[1:5])[24:]
          + capture_bytes([rows[5]], body)[24:] + capture_bytes(rows[6:])[24:])
    found = captures.Captures(spark, folder, chunk)
    assert found.packets.count() == 9 and found.summary().first()["problem"] is None
    assert found.index.count() == -(-found.summary().first()["bytes"] // chunk)


@pytest.mark.parametrize("seed", range(4))
def test_any_split_gives_what_one_read_gives(spark, folder, seed):
    """Random records, some with bytes that look like headers, and a damaged middle."""
    rng = random.Random(seed)
    data = capture_bytes([])
    for _ in range(rng.randint(20, 60)):
        body = rng.choice([bytes(rng.randrange(300)), rng.randbytes(rng.randrange(200)), struct.pack("<IIII", 1, 1, 40, 40) * rng.randrange(9)])
        data += struct.pack("<IIII", rng.randrange(2**31), rng.randrange(10**6), len(body), len(body)) + body
    if seed % 2:
        at = rng.randrange(24, len(data))
        data = data[:at] + b"\xff" * 9 + data[at + 9 :]
    write(folder, x__pcap=data)

    def read(chunk):
        got = captures.Captures(spark, folder, chunk)
        return sorted(map(tuple, got.packets.collect()), key=str), got.summary().collect()

    whole = read(10**6)
    layout = form.layout_of(data[:24])
    starts, reached, problem = form.walk(data, 0, 24, len(data), len(data), layout)
    assert len(whole[0]) == len(starts) and whole[1][0]["unread_bytes"] == len(data) - reached and whole[1][0]["problem"] == problem
    for chunk in (37, 64, 333, 2000):
        assert read(chunk) == whole


def test_ways_survive_packing():
    rng = np.random.default_rng(1)
    starts = np.sort(rng.choice(10_000, 500, replace=False))
    ends = rng.choice([12_000, 12_016, -9, -20], 500)
    a, b = captures.decode_ways(captures.encode_ways(starts, ends))
    assert (a == starts).all() and (b == ends).all()


def test_block_files(spark, folder):
    """Two sections in both byte orders, interfaces with other time units and link types, old and simple blocks."""
    frame = capture_bytes(sorted(random_packets(1), key=lambda r: r[1]))[40:]

    def block(order, kind, body):
        body += bytes(-len(body) % 4)
        size = struct.pack(order + "I", len(body) + 12)
        return struct.pack(order + "I", kind) + size + body + size

    def section(order):
        return block(order, 0x0A0D0D0A, struct.pack(order + "IHHq", 0x1A2B3C4D, 1, 0, -1))

    def packet(order, number, units, data=frame):
        return block(order, 6, struct.pack(order + "IIIII", number, units >> 32, units & 0xFFFFFFFF, len(data), len(data)) + data)

    nano = struct.pack("<HHBxxx", 9, 1, 9) + struct.pack("<HHq", 14, 8, 100) + bytes(4)
    power = struct.pack(">HHBxxx", 9, 1, 0x8A) + bytes(4)
    data = section("<") + block("<", 1, struct.pack("<HHI", 1, 0, 0) + nano) + block("<", 1, struct.pack("<HHI", 101, 0, 0))
    data += packet("<", 0, 5_000_000_123_456_789) + packet("<", 1, 7_000_000, frame[14:]) + packet("<", 9, 1)
    data += block("<", 0x99, b"unknown") + block("<", 3, struct.pack("<I", len(frame)) + frame)
    data += section(">") + block(">", 1, struct.pack(">HHI", 1, 0, 0) + power) + packet(">", 0, 3 * 1024)
    data += block(">", 2, struct.pack(">HHIIII", 0, 0, 0, 2048, len(frame), len(frame)) + frame)
    write(folder, a__pcapng=data, b__pcapng=data + b"\0" * 40, c__pcapng__gz=gzip.compress(data), d__pcap=data)
    got = captures.read_captures(spark, folder, 200).filter("capture_path like '%a.pcapng'").orderBy("packet_id").collect()
    assert [r["ts_us"] for r in got] == [5_000_100_123_456, 7_000_000, 0, 3_000_000, 2_000_000]
    assert len({(r["src_ip"], r["dst_port"], r["payload_len"]) for r in got}) == 1 and got[0]["src_ip"] == "10.0.0.1"
    found = summary(spark, folder)
    assert {k: v[2:] for k, v in found.items()} == {
        "a.pcapng": (5, 5, 0, 0, None), "b.pcapng": (5, 5, 0, 40, "damaged"), "c.pcapng.gz": (5, 5, 0, 0, None), "d.pcap": (5, 5, 0, 0, None)}


@pytest.mark.parametrize("kind", capture_sink.FORMS)
def test_written_captures_come_back(spark, kind):
    rows = raw_frame(spark, random_packets(50)).withColumns({"scenario": F.lit("baseline"), "part": F.lit(0), "form": F.lit(kind)})
    folder = capture_sink.write_captures(rows, fresh_dir(spark, "round"))
    fields = ["ts_us", "src_ip", "dst_ip", "src_port", "dst_port", "payload_len", "pkt_len", "proto", "flags"]
    got = captures.read_captures(spark, folder, 2000)
    assert sorted(map(tuple, got.select(fields).collect())) == sorted(map(tuple, rows.select(fields).collect()))
    assert got.select("packet_id").distinct().count() == 50


def test_no_files(spark, folder):
    assert captures.read_captures(spark, folder).count() == 0
    assert captures.Captures(spark, folder).summary().count() == 0


def test_chains_of_zeros_are_followed_as_one_read_would():
    """Every byte may start a record here; the map must not be followed byte by byte in Python."""
    rng = np.random.default_rng(3)
    layout = form.layout_of(capture_bytes([])[:24])
    data = bytearray(3 * form.BLOCK + 77)
    for at in rng.integers(0, len(data) - 4, 40):
        data[at : at + 4] = struct.pack("<I", int(rng.choice([3, 500, 70_000, 2**31])))
    data, begin = bytes(data), 1000
    end, length = begin + len(data) - 16, begin + len(data) - 16 + int(rng.integers(0, 16))
    starts = form.possible_starts(data, begin, end, length, layout)
    ends = form.ends_of(data, begin, starts, end, length, layout)
    for i in rng.integers(0, len(starts), 60).tolist():
        _, reached, problem = form.walk(data, begin, int(starts[i]), end, length, layout)
        assert ends[i] == (reached if problem is None else -1 - 2 * reached - (problem == form.DAMAGED))


def test_many_chunks_share_tasks():
    pieces = [(0, 0, 0, 0, 0, i, 0, 1_000) for i in range(100_000)]
    tasks = captures.packed(pieces, lambda p: p[7] - p[6], 1_000)
    assert len(tasks) <= captures.TASKS + 1 and sum((t.pieces for t in tasks), []) == pieces


@pytest.mark.parametrize("order", "<>")
def test_records_cut_by_a_snap_length_keep_the_length_of_their_frames(spark, folder, order):
    """Lengths that no frame can have are not believed."""
    frame = capture_bytes(sorted(random_packets(1), key=lambda r: r[1]))[40:][:54]
    data = struct.pack(order + "IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 54, 1)
    for whole in (1500, 54, 53, 0, 2**31 - 1, 2**31, 2**32 - 1):
        data += struct.pack(order + "IIII", 1, 0, 54, whole) + frame

    def block(kind, body):
        body += bytes(-len(body) % 4)
        size = struct.pack(order + "I", len(body) + 12)
        return struct.pack(order + "I", kind) + size + body + size

    blocks = block(0x0A0D0D0A, struct.pack(order + "IHHq", 0x1A2B3C4D, 1, 0, -1)) + block(1, struct.pack(order + "HHI", 1, 0, 54))
    blocks += block(6, struct.pack(order + "IIIII", 0, 0, 1, 54, 1500) + frame) + block(3, struct.pack(order + "I", 1400) + frame)
    blocks += block(2, struct.pack(order + "HHIIII", 0, 0, 0, 2, 54, 1300) + frame)
    write(folder, a__pcap=data, b__pcapng=blocks, c__pcap__gz=gzip.compress(data))
    got = captures.read_captures(spark, folder, 100).orderBy("packet_id").collect()
    lengths = {n: [r["pkt_len"] for r in got if r["capture_path"].endswith(n)] for n in ("a.pcap", "b.pcapng", "c.pcap.gz")}
    assert lengths["a.pcap"] == lengths["c.pcap.gz"] == [1500, 54, 54, 54, 2**31 - 1, 54, 54]
    assert lengths["b.pcapng"] == [1500, 1400, 1300]
    assert all(r["src_ip"] == "10.0.0.1" and r["proto"] == 6 for r in got)


@pytest.mark.parametrize("kind", capture_sink.FORMS)
def test_headers_alone_bring_every_packet_back(spark, kind):
    """TCP and UDP, payloads that fit the stored bytes in part, in whole and not at all."""
    rows = [(*r[:6], n, n + (42 if udp else 54), 17 if udp else 6, None if udp else r[9])
            for r, (n, udp) in zip(random_packets(40), [(n, u) for n in (0, 1, 11, 12, 13, 1400, 30_000, 65_000) for u in (True, False)] * 3)]
    named = raw_frame(spark, rows).withColumns({"scenario": F.lit("baseline"), "part": F.lit(0), "form": F.lit(kind)})
    fields = ["ts_us", "src_ip", "dst_ip", "src_port", "dst_port", "payload_len", "pkt_len", "proto", "flags"]
    want = sorted(map(tuple, named.select(fields).collect()), key=str)
    size = {}
    for longest in (capture_sink.HEADERS, form.LONGEST_RECORD):
        found = captures.Captures(spark, capture_sink.write_captures(named, fresh_dir(spark, "cut"), longest), 2000)
        assert sorted(map(tuple, found.packets.select(fields).collect()), key=str) == want
        (file,) = found.summary().collect()
        assert (file["packets"], file["unread_bytes"], file["problem"]) == (40, 0, None)
        size[longest] = file["bytes"]
    assert size[capture_sink.HEADERS] < size[form.LONGEST_RECORD] and size[capture_sink.HEADERS] <= 200 + 40 * (54 + 34)


def test_files_of_the_queries_do_not_grow_with_payloads(spark, sf):
    files = capture_queries.captured(spark, sf, "raw_packets").summary().collect()
    assert sum(r["bytes"] for r in files) < 100 * sum(r["packets"] for r in files)


def test_the_summary_leaves_little_in_the_shared_folder(spark, sf):
    def left():
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(f"{shared_root(spark)}/leakwatch") for f in names)

    before = left()
    rows = capture_queries.capture_summary(spark, sf).collect()
    packets = sum(r["packets"] for r in rows)
    assert packets == spark.read.parquet(f"{sf}/events.parquet").count() and not any(r["unread_bytes"] or r["problem"] for r in rows)
    assert left() - before < 150 * packets


@pytest.mark.parametrize("chunk", [50, 1000])
def test_a_file_of_cut_frames_that_ends_early_is_reported(spark, folder, chunk):
    """What is missing is told from the bytes stored, not from the length of the frames."""
    frame = capture_bytes(sorted(random_packets(1), key=lambda r: r[1]))[40:][:54]
    data = struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, 54, 1) + (struct.pack("<IIII", 1, 0, 54, 1500) + frame) * 3
    write(folder, whole__pcap=data, cut__pcap=data[:-1])
    got = summary(spark, folder, chunk)
    assert got == {"whole.pcap": ("pcap", len(data), 3, 3, 0, 0, None), "cut.pcap": ("pcap", len(data) - 1, 2, 2, 0, 69, "truncated")}
