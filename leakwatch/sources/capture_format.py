"""Byte layout of packet capture files: record chains, block chains and frame fields.

Two formats are known, plain or gzipped: libpcap, a header and a chain of length-prefixed
records, and pcapng, a chain of blocks that repeat their length at their end.
"""

import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyarrow import fs

# Fixed values of the file formats.
FILE_HEADER = 24
RECORD_HEADER = 16
MAGICS = {
    b"\xd4\xc3\xb2\xa1": ("<", 1),
    b"\xa1\xb2\xc3\xd4": (">", 1),
    b"\x4d\x3c\xb2\xa1": ("<", 1000),
    b"\xa1\xb2\x3c\x4d": (">", 1000),
}
SECTION = 0x0A0D0D0A
SECTION_ORDERS = {b"\x4d\x3c\x2b\x1a": "<", b"\x1a\x2b\x3c\x4d": ">"}
INTERFACE, OLD_PACKET, SIMPLE_PACKET, PACKET = 1, 2, 3, 6
TIME_UNIT, TIME_OFFSET = 9, 14  # interface options
GZIP = b"\x1f\x8b"
LINK_HEADERS = {0: 4, 1: 14, 101: 0, 113: 16}
# No record may be longer than this, unless the file's own limit says so; a longer one is damage.
LONGEST_RECORD = 262_144
LONGEST_BLOCK = 1 << 27
LONGEST_FRAME = (1 << 31) - 1
# Bytes through which chains of records are followed at once.
BLOCK = 1 << 17
READ_BYTES = 4 * 1024 * 1024

TRUNCATED, DAMAGED, FOREIGN, EMPTY = "truncated", "damaged", "foreign", "empty"


@dataclass(frozen=True)
class Layout:
    """What the header of a libpcap file says of its records."""

    order: str
    per_us: int
    link: int
    longest: int


def store_of(root):
    """Filesystem of a folder and the folder's path in it."""
    return fs.FileSystem.from_uri("/" + root[5:].lstrip("/") if root.startswith("file:") else root)


def layout_of(head):
    """Layout from the first 24 bytes; None if they are no libpcap header."""
    if head[:4] not in MAGICS or len(head) < FILE_HEADER:
        return None
    order, per_us = MAGICS[head[:4]]
    longest, link = struct.unpack_from(order + "II", head, 16)
    return Layout(order, per_us, link & 0xFFFF, max(LONGEST_RECORD, longest if longest < LONGEST_BLOCK else 0))


def kind_of(head):
    """pcap, pcapng, empty or foreign, from the first bytes of a file or of its unpacked stream."""
    if not head:
        return EMPTY
    if head[:4] in MAGICS:
        return "pcap"
    return "pcapng" if head[:4] == b"\x0a\x0d\x0d\x0a" and head[8:12] in SECTION_ORDERS else FOREIGN


def walk(data, base, at, stop, length, layout):
    """Follow records from `at` to the first that starts at `stop` or later.

    `data` holds the bytes from `base` on, up to 16 bytes past `stop`. Returns the starts of the
    whole records, where the chain got to, and why it ended early: truncated, damaged, or None.
    """
    held_of = struct.Struct(layout.order + "I").unpack_from
    starts = []
    while at < stop:
        if at + RECORD_HEADER > length:
            return starts, at, TRUNCATED
        held = held_of(data, at - base + 8)[0]
        if held > layout.longest:
            return starts, at, DAMAGED
        if at + RECORD_HEADER + held > length:
            return starts, at, TRUNCATED
        starts.append(at)
        at += RECORD_HEADER + held
    return starts, at, None


def possible_starts(data, begin, end, length, layout):
    """All places of a chunk where the chain of the chunk before may arrive and go on."""
    count = min(layout.longest + RECORD_HEADER, end - begin)
    cells = np.zeros(count + RECORD_HEADER, np.uint8)
    known = np.frombuffer(data[: len(cells)], np.uint8)
    cells[: len(known)] = known
    places = range(8, 12) if layout.order == "<" else range(11, 7, -1)
    held = sum(cells[p : p + count].astype(np.int64) << (8 * i) for i, p in enumerate(places))
    cut = np.arange(begin, begin + count) + RECORD_HEADER > length
    return begin + np.flatnonzero(cut | (held <= layout.longest))


def ends_of(data, begin, starts, end, length, layout):
    """Where the chain from each possible start leaves the chunk: a place at `end` or later, or
    -1 - 2 * place (less 1 for damage) where it stops. All chains are followed at once through one block of
    bytes after the other, by doubling steps inside a block, so the time hardly depends on the bytes."""
    size = end - begin
    cells = np.zeros(size + RECORD_HEADER, np.uint8)
    known = np.frombuffer(data, np.uint8)[: len(cells)]
    cells[: len(known)] = known
    # The length that a record at any byte would have.
    held = np.ndarray(size, layout.order + "u4", cells.data, 8, (1,))
    at = starts - begin
    for low in range(0, size, BLOCK):
        inside = np.flatnonzero((at >= low) & (at < min(low + BLOCK, size)))
        if not len(inside):
            continue
        part = held[low : low + BLOCK].astype(np.int64)
        own = np.arange(len(part))
        after = own + RECORD_HEADER + part
        whole = (part <= layout.longest) & (after <= length - begin - low)
        jump = np.where(whole & (after < len(part)), after, own)
        entry = at[inside] - low
        while True:
            entry = jump[entry]
            if (jump[entry] == entry).all():
                break
            jump = jump[jump]
        at[inside] = low + np.where(whole, after, own)[entry]
    stopped = np.flatnonzero(at < size)
    place = at + begin
    cut = place[stopped] + RECORD_HEADER > length
    place[stopped] = -1 - 2 * place[stopped] - (~cut & (held[at[stopped]] > layout.longest))
    return place


class Stream:
    """A file read once from front to end, unpacked if it is gzipped."""

    def __init__(self, handle, gzipped):
        self.handle = handle
        self.unpack = zlib.decompressobj(zlib.MAX_WBITS | 16) if gzipped else None
        self.broken, self.packed = False, b""

    def read(self, size):
        """Up to `size` bytes, at least one before the end. What can be unpacked of a damaged
        or cut file is handed out; `broken` tells of the rest."""
        if self.unpack is None:
            return self.handle.read(size)
        out = b""
        while not out and not self.broken:
            if self.unpack.eof:  # a file may hold several packed members
                self.packed = self.unpack.unused_data or self.packed or self.handle.read(READ_BYTES)
                if not self.packed:
                    break
                self.unpack = zlib.decompressobj(zlib.MAX_WBITS | 16)
            self.packed = self.packed or self.handle.read(READ_BYTES)
            if not self.packed:
                self.broken = True  # the end of the member is missing
                out = self.unpack.flush()
                break
            try:
                out = self.unpack.decompress(self.packed, size)
                self.packed = self.unpack.unconsumed_tail
            except zlib.error:
                self.broken = True
        return out


class Frames:
    """Frames of one link type inside a block of bytes."""

    def __init__(self):
        self.place, self.frame, self.held, self.whole, self.ts_us = [], [], [], [], []

    def add(self, place, frame, held, whole, ts_us):
        self.place.append(place)
        self.frame.append(frame)
        self.held.append(held)
        self.whole.append(whole)
        self.ts_us.append(ts_us)

    def columns(self, data, link):
        return frame_columns(data, *(np.array(v, np.int64) for v in (self.frame, self.held, self.whole, self.ts_us)), link)


def record_columns(data, base, starts, layout):
    """Packets of the records at the given places; `data` holds the bytes from `base` on."""
    cells = np.frombuffer(data, np.uint8)
    at = np.array(starts, np.int64) - base

    def word(shift):
        view = np.ascontiguousarray(cells[(at + shift)[:, None] + np.arange(4)])
        return view.view(layout.order + "u4")[:, 0].astype(np.int64)

    ts_us = word(0) * 1_000_000 + word(4) // layout.per_us
    return frame_columns(data, at + RECORD_HEADER, word(8), word(12), ts_us, layout.link)


class PcapStream:
    """Packets of a libpcap stream, in blocks; afterwards `reached`, `left` (bytes read but not used) and `problem` are known."""

    def __init__(self, stream):
        self.stream, self.reached, self.left, self.problem = stream, 0, 0, None

    def __iter__(self):
        held = b""
        while len(held) < FILE_HEADER and (more := self.stream.read(FILE_HEADER - len(held))):
            held += more
        layout, self.reached = layout_of(held), min(len(held), FILE_HEADER)
        if layout is None:
            self.reached, self.left, self.problem = 0, len(held), TRUNCATED
            return
        data, base = b"", FILE_HEADER
        while True:
            more = self.stream.read(READ_BYTES)
            data += more
            end = base + len(data)
            # A record that is cut by the block is looked at again with the next one.
            starts, at, why = walk(data, base, base, end, end, layout)
            if starts:
                yield starts, record_columns(data, base, starts, layout)
            self.reached, self.left = at, end - at
            if why == DAMAGED or not more:
                self.problem = why
                return
            data, base = data[at - base :], at


class BlockStream:
    """Packets of a pcapng stream, in blocks; afterwards `reached`, `left` (bytes read but not used) and `problem` are known."""

    def __init__(self, stream):
        self.stream, self.reached, self.left, self.problem = stream, 0, 0, None
        self.order, self.interfaces = "<", []

    def __iter__(self):
        data, base = b"", 0
        while True:
            more = self.stream.read(READ_BYTES)
            data += more
            found, at = {}, 0
            while True:
                size = self.block_size(data, at)
                if size is None or size == DAMAGED:
                    break
                self.take(data, at, size, base, found)
                at += size
            for link, frames in found.items():
                yield frames.place, frames.columns(data, link)
            self.reached, self.left = base + at, len(data) - at
            if size == DAMAGED or not more:
                self.problem = DAMAGED if size == DAMAGED else TRUNCATED if at < len(data) else None
                return
            data, base = data[at:], base + at

    def block_size(self, data, at):
        """Bytes of the block at a place; None if it is not whole, or DAMAGED."""
        if at + 12 > len(data):
            return None
        if data[at : at + 4] == b"\x0a\x0d\x0d\x0a":
            order = SECTION_ORDERS.get(data[at + 8 : at + 12])
            if order is None:
                return DAMAGED
            self.order, self.interfaces = order, []
        size = struct.unpack_from(self.order + "I", data, at + 4)[0]
        if size < 12 or size % 4 or size > LONGEST_BLOCK:
            return DAMAGED
        if at + size > len(data):
            return None
        return size if struct.unpack_from(self.order + "I", data, at + size - 4)[0] == size else DAMAGED

    def take(self, data, at, size, base, found):
        kind = struct.unpack_from(self.order + "I", data, at)[0]
        if kind == INTERFACE and size >= 20:
            self.interfaces.append(self.interface(data, at, size))
        elif kind in (PACKET, OLD_PACKET) and size >= 32:
            number, high, low, held, whole = struct.unpack_from(self.order + "IIIII", data, at + 8)
            if kind == OLD_PACKET:
                number = struct.unpack_from(self.order + "H", data, at + 8)[0]
            if number < len(self.interfaces) and held <= size - 32:
                link, _, units, offset = self.interfaces[number]
                ts_us = ((high << 32) | low) * 1_000_000 // units + offset * 1_000_000
                found.setdefault(link, Frames()).add(base + at, at + 28, held, whole, ts_us)
        elif kind == SIMPLE_PACKET and self.interfaces and size >= 16:
            link, longest, _, _ = self.interfaces[0]
            whole = struct.unpack_from(self.order + "I", data, at + 8)[0]
            held = min(whole, size - 16, longest or size)
            found.setdefault(link, Frames()).add(base + at, at + 12, held, whole, 0)

    def interface(self, data, at, size):
        """(link type, longest packet, time units a second, offset in seconds) of an interface block."""
        link, _, longest = struct.unpack_from(self.order + "HHI", data, at + 8)
        units, offset, place = 1_000_000, 0, at + 16
        while place + 4 <= at + size - 4:
            code, length = struct.unpack_from(self.order + "HH", data, place)
            if code == 0 or place + 4 + length > at + size - 4:
                break
            if code == TIME_UNIT and length == 1:
                value = data[place + 4]
                units = 2 ** (value & 127) if value & 128 else 10**value
            elif code == TIME_OFFSET and length == 8:
                offset = struct.unpack_from(self.order + "q", data, place + 4)[0]
            place += 4 + (length + 3) // 4 * 4
        return link, longest, units, offset


def open_stream(handle, kind):
    """Iterator over (places, packet columns) of a stream of a kind such as `pcap.gz`."""
    stream = Stream(handle, kind.endswith(".gz"))
    return (BlockStream if kind.startswith("pcapng") else PcapStream)(stream)


def _address(cells):
    """Four byte columns to dotted text."""
    text = [pd.Series(c).astype(str) for c in cells]
    return text[0] + "." + text[1] + "." + text[2] + "." + text[3]


def frame_columns(data, frame, held, whole, ts_us, link_type):
    """Packet fields of the frames at the given places, gathered all at once.

    A capture may hold only the first bytes of a frame; `whole` is the length that the frame had. Where a record names
    one that is shorter than what it holds, or that no column takes, the bytes held count.
    """
    data = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(128, np.uint8)])

    def short(where):
        return (data[where].astype(np.int64) << 8) | data[where + 1]

    link = LINK_HEADERS.get(link_type)
    if link is None:
        ip, is_ip = frame, np.zeros(len(frame), bool)
    elif link_type == 1:
        tagged = short(frame + 12) == 0x8100
        ip = frame + link + 4 * tagged
        is_ip = short(ip - 2) == 0x0800
    elif link_type == 113:
        ip = frame + link
        is_ip = short(ip - 2) == 0x0800
    else:
        ip = frame + link
        is_ip = np.ones(len(frame), bool)
    # Short frames would read into the next record.
    fits = (ip - frame) + 20 <= held
    ip = np.where(fits, ip, frame)
    is_ip &= fits & (data[ip] >> 4 == 4)
    header = (data[ip] & 15).astype(np.int64) * 4
    total = short(ip + 2)
    fragment = short(ip + 6) & 0x1FFF
    proto = data[ip + 9].astype(np.int64)
    upper = ip + header
    room = held - (upper - frame)
    tcp = is_ip & (proto == 6) & (fragment == 0) & (room >= 20)
    udp = is_ip & (proto == 17) & (fragment == 0) & (room >= 8)
    ported = tcp | udp
    upper = np.where(ported, upper, frame)
    offset = np.where(tcp, (data[upper + 12] >> 4).astype(np.int64) * 4, 8)
    payload = np.maximum(total - header - offset, 0)
    other = is_ip & ~np.isin(proto, (6, 17))
    return {
        "ts_us": ts_us,
        "src_ip": np.where(is_ip, _address([data[ip + 12 + i] for i in range(4)]), None),
        "dst_ip": np.where(is_ip, _address([data[ip + 16 + i] for i in range(4)]), None),
        "src_port": np.where(ported, short(upper), 0),
        "dst_port": np.where(ported, short(upper + 2), 0),
        "payload_len": np.where(ported, payload, 0),
        "pkt_len": np.where((whole < held) | (whole > LONGEST_FRAME), held, whole),
        "proto": np.where(ported | other, proto, 0),
        "flags": np.where(tcp, data[upper + 13].astype(float), np.nan),
    }
