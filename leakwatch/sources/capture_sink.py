"""Packets written as capture files, for tools that read nothing else."""

import gzip
import struct

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from leakwatch.sources import capture_format as form

FORMS = ("pcap", "pcap.gz", "pcapng")
# Bytes of the headers around a payload: Ethernet, IPv4 and TCP, the longest of those written here.
HEADERS = 14 + 20 + 20


def frame_of(row, longest):
    """Ethernet, IPv4, TCP or UDP around an empty payload of the packet's length: the first bytes of the frame, as
    many as a capture that keeps `longest` holds, and the length of the whole frame."""
    udp = row.proto == 17
    upper = 8 if udp else 20
    ip = struct.pack(
        ">BBHHHBBH4s4s", 0x45, 0, 20 + upper + row.payload_len, 0, 0, 64, row.proto, 0,
        bytes(map(int, row.src_ip.split("."))), bytes(map(int, row.dst_ip.split("."))),
    )
    if udp:
        top = struct.pack(">HHHH", row.src_port, row.dst_port, 8 + row.payload_len, 0)
    else:
        flags = 0 if pd.isna(row.flags) else int(row.flags)
        top = struct.pack(">HHIIBBHHH", row.src_port, row.dst_port, 0, 0, 0x50, flags, 0, 0, 0)
    head = bytes(12) + b"\x08\x00" + ip + top
    whole = len(head) + row.payload_len
    return (head + bytes(max(min(whole, longest) - len(head), 0)))[:longest], whole


def block(kind, body):
    body += bytes(-len(body) % 4)
    size = struct.pack("<I", len(body) + 12)
    return struct.pack("<I", kind) + size + body + size


def file_bytes(rows, kind, longest=form.LONGEST_RECORD):
    """Parts of a file with the given packets, in a form of FORMS. No record holds more than `longest` bytes of its frame."""
    if kind == "pcapng":
        yield block(form.SECTION, struct.pack("<IHHq", 0x1A2B3C4D, 1, 0, -1))
        yield block(form.INTERFACE, struct.pack("<HHI", 1, 0, longest))
    else:
        yield struct.pack("<IHHiIII", 0xA1B2C3D4, 2, 4, 0, 0, longest, 1)
    for row in rows:
        frame, whole = frame_of(row, longest)
        if kind == "pcapng":
            yield block(form.PACKET, struct.pack("<IIIII", 0, row.ts_us >> 32, row.ts_us & 0xFFFFFFFF, len(frame), whole) + frame)
        else:
            yield struct.pack("<IIII", row.ts_us // 1_000_000, row.ts_us % 1_000_000, len(frame), whole) + frame


def write_captures(rows, folder, longest=form.LONGEST_RECORD):
    """One capture file per (scenario, part), written by the tasks. Returns the folder.

    Rows are raw packets with `scenario`, `part` and, where it is not pcap, `form`. A file is named by them, so a
    repeated task writes the same file again. A part should hold a bounded number of packets. `longest` is the snap
    length of the captures: as many bytes of a frame are stored, and with them the length of the whole frame. Rows have
    no payload, so HEADERS of them hold all that the rows say, and the files do not grow with the payloads' lengths.
    """

    def write(group):
        group = group.sort_values(["ts_us", "packet_id"])
        name, part, kind = (group[c].iloc[0] for c in ("scenario", "part", "form"))
        store, base = form.store_of(f"{folder}/{name}")
        store.create_dir(base, recursive=True)
        data = b"".join(file_bytes(group.itertuples(index=False), kind, longest))
        with store.open_output_stream(f"{base}/part-{int(part)}.{kind}", compression=None) as out:
            out.write(gzip.compress(data, 1, mtime=0) if kind.endswith(".gz") else data)
        return pd.DataFrame({"records": np.array([len(group)], dtype=np.int64)})

    if "form" not in rows.columns:
        rows = rows.withColumn("form", F.lit(FORMS[0]))
    rows.groupBy("scenario", "part", "form").applyInPandas(write, "records bigint").agg(F.sum("records")).first()
    return folder
