"""Packet capture files as a splittable Spark data source.

A capture is a chain of length-prefixed records without sync marks, so a task that opens a file in
its middle does not know where a record starts. Each chunk therefore reports a map: for every
place where the chain of the chunk before may arrive, the place where its own chain leaves. Maps
compose, so one ordered pass over them, without a look at the files, proves the first record of
every chunk. The number of jobs does not depend on the files; the result is that of one
sequential read. Gzipped files and pcapng files are read front to end by one task each.
"""

import fnmatch
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from leakwatch.functions import schemas
from leakwatch.session import fresh_dir
from leakwatch.sources import capture_format as form

CHUNK_BYTES = 64 * 1024 * 1024
PATTERNS = "*.pcap,*.pcap.gz,*.pcapng,*.pcapng.gz,*.cap"
# Many chunks are dealt to about this many tasks, as long as a task reads no more than CHUNK_BYTES.
TASKS = 256
# Deflate cannot pack more than this many bytes into one; packet ids leave that room.
MOST_UNPACKED = 1040

CHUNK_FIELDS = [
    T.StructField("root", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("base", T.LongType()),
    T.StructField("kind", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("chunk", T.LongType()),
    T.StructField("begin", T.LongType()),
    T.StructField("end", T.LongType()),
]
MAPS = T.StructType([
    *CHUNK_FIELDS,
    T.StructField("ways", T.BinaryType()),
    T.StructField("next", T.LongType()),
    T.StructField("unread", T.LongType()),
    T.StructField("problem", T.StringType()),
])
INDEX = T.StructType([
    *CHUNK_FIELDS,
    T.StructField("first", T.LongType()),
    T.StructField("next", T.LongType()),
    T.StructField("unread", T.LongType()),
    T.StructField("problem", T.StringType()),
])
CAPTURED = T.StructType([*schemas.RAW_PACKET.fields, T.StructField("capture_path", T.StringType())])


@dataclass
class Pieces(InputPartition):
    """Pieces of files that one task reads: tuples in the order of the fields of a chunk."""

    pieces: list


def packed(pieces, size_of, most):
    """Group consecutive pieces, so that a task reads about `most` bytes of small files, or more of many chunks."""
    groups, held = [], 0
    most = max(most, min(CHUNK_BYTES, sum(map(size_of, pieces)) // TASKS))
    for piece in pieces:
        size = size_of(piece)
        if not groups or held + size > most:
            groups.append([])
            held = 0
        groups[-1].append(piece)
        held += size
    return [Pieces(g) for g in groups]


def encode_ways(starts, ends):
    """Pack a map from places to places: few distinct ends, regular steps between starts."""
    distinct, which = np.unique(ends, return_inverse=True)
    head = np.array([len(starts), len(distinct)], np.int64)
    steps = np.diff(starts, prepend=0)
    return zlib.compress(head.tobytes() + steps.tobytes() + distinct.tobytes() + which.astype(np.int32).tobytes(), 1)


def decode_ways(data):
    raw = zlib.decompress(data)
    n, m = np.frombuffer(raw, np.int64, 2)
    starts = np.cumsum(np.frombuffer(raw, np.int64, n, 16))
    distinct = np.frombuffer(raw, np.int64, m, 16 + 8 * n)
    return starts, distinct[np.frombuffer(raw, np.int32, n, 16 + 8 * (n + m))]


class MapReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"]
        self.chunk_bytes = int(options.get("chunkbytes", CHUNK_BYTES))
        self.patterns = options.get("pattern", PATTERNS).split(",")

    def partitions(self):
        """Chunks of all matching files below the folder, in the order of their paths."""
        store, base = form.store_of(self.root)
        found = store.get_file_info(base)
        if found.type == fs.FileType.Directory:
            found = store.get_file_info(fs.FileSelector(base, recursive=True))
        else:
            found = [found]
        files = sorted(
            (f for f in found if f.type == fs.FileType.File and any(fnmatch.fnmatch(f.base_name, p) for p in self.patterns)),
            key=lambda f: f.path,
        )
        if not files:
            return [Pieces([])]
        pieces, first_id = [], 0
        for file in files:
            whole = file.base_name.endswith((".gz", ".pcapng"))
            step = max(file.size, 1) if whole else self.chunk_bytes
            for chunk, begin in enumerate(range(0, max(file.size, 1), step)):
                pieces.append((self.root, file.path, first_id, None, file.size, chunk, begin, min(begin + step, file.size)))
            first_id += max(file.size, 1) * (MOST_UNPACKED if file.base_name.endswith(".gz") else 1)
        return packed(pieces, lambda p: p[7] - p[6], self.chunk_bytes)

    def read(self, partition):
        rows = [chunk_map(piece) for piece in partition.pieces]
        schema = to_arrow_schema(MAPS)
        columns = list(zip(*rows)) or [[] for _ in schema]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def chunk_map(piece):
    """The row of a chunk: its map, or for a file that cannot be split how far it can be read."""
    root, path, base, _, length, chunk, begin, end = piece
    with form.store_of(root)[0].open_input_file(path) as handle:
        head = handle.read_at(min(form.FILE_HEADER, length), 0) if length else b""
        gzipped = head[:2] == form.GZIP
        handle.seek(0)
        if gzipped:
            head = form.Stream(handle, True).read(form.FILE_HEADER)
            handle.seek(0)
        kind = form.kind_of(head) + (".gz" if gzipped else "")
        if kind.startswith((form.EMPTY, form.FOREIGN)):
            problem = form.EMPTY if length == 0 else form.FOREIGN
            return (root, path, base, problem, length, chunk, begin, end, None, begin, end - begin, problem)
        if kind == "pcap" and not path.endswith((".gz", ".pcapng")):
            return split_map(piece, handle, form.layout_of(head))
        row = (root, path, base, kind, length, chunk, begin, end, None)
        if chunk:  # the file's name did not show that it is read as a whole; the first chunk does it
            return (*row, begin, 0, None)
        records = form.open_stream(handle, kind)
        for _ in records:
            pass
        unread = records.left
        while more := records.stream.read(form.READ_BYTES):
            unread += len(more)
        problem = records.problem or (form.TRUNCATED if records.stream.broken else None)
        return (*row, records.reached, unread, problem)


def split_map(piece, handle, layout):
    root, path, base, _, length, chunk, begin, end = piece
    row = (root, path, base, "pcap", length, chunk, begin, end)
    if layout is None:
        return (*row, None, begin, end - begin, form.TRUNCATED)
    data = handle.read_at(min(end + form.RECORD_HEADER, length) - begin, begin)
    if chunk == 0:
        starts = np.array([form.FILE_HEADER], np.int64)
    else:
        starts = form.possible_starts(data, begin, end, length, layout)
    ends = form.ends_of(data, begin, starts, end, length, layout)
    return (*row, encode_ways(starts, ends), None, None, None)


def prove(batches):
    """mapInArrow function over maps sorted by path and chunk: follow each file's chain through them."""
    path, at, stopped = None, 0, False
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            row = [r[f.name] for f in CHUNK_FIELDS]
            if r["path"] != path:
                path, at, stopped = r["path"], form.FILE_HEADER, False
            if r["ways"] is None:
                rows.append((*row, 0 if r["next"] > r["begin"] else r["begin"], r["next"], r["unread"], r["problem"]))
                continue
            first, problem = at, None
            if stopped or at >= r["end"]:
                # Nothing starts here: the chunk lies inside a record, or after the end of the chain.
                after = first = r["begin"]
                unread = r["end"] - r["begin"] if stopped else 0
            else:
                starts, ends = decode_ways(r["ways"])
                i = int(np.searchsorted(starts, at))
                end = int(ends[i]) if i < len(starts) and starts[i] == at else -2 - 2 * at
                if end >= 0:
                    at = after = end
                    unread = 0
                else:
                    after, damaged = divmod(-1 - end, 2)
                    stopped, problem = True, form.DAMAGED if damaged else form.TRUNCATED
                    unread = r["end"] - after
            rows.append((*row, first, after, unread, problem))
        columns = list(zip(*rows)) or [[] for _ in INDEX]
        schema = to_arrow_schema(INDEX)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


class PacketReader(DataSourceReader):
    def __init__(self, options):
        self.index = options["index"]
        self.chunk_bytes = int(options.get("chunkbytes", CHUNK_BYTES))

    def partitions(self):
        """Proved chunks that hold records, from the written index."""
        store, base = form.store_of(self.index)
        table = pq.read_table(base, filesystem=store, columns=INDEX.names)
        rows = [tuple(r.values()) for r in table.to_pylist() if r["next"] > r["first"]]
        rows.sort(key=lambda r: (r[2], r[5]))
        return packed(rows, lambda r: r[7] - r[6], self.chunk_bytes) or [Pieces([])]

    def read(self, partition):
        for piece in partition.pieces:
            yield from packets_of(piece)


def packets_of(piece):
    """Arrow batches of the packets of one proved chunk, or of a whole file that is not split."""
    root, path, base, kind, length, _, _, end, first, after = piece[:10]
    with form.store_of(root)[0].open_input_file(path) as handle:
        if kind == "pcap" and not path.endswith((".gz", ".pcapng")):
            layout = form.layout_of(handle.read_at(form.FILE_HEADER, 0))
            # Records may end beyond the chunk; they are read in steps, so that one task holds a bounded part.
            at = first
            while at < min(after, end):
                size = min(after, at + form.READ_BYTES + layout.longest + form.RECORD_HEADER) - at
                data = handle.read_at(size, at)
                starts, reached, _ = form.walk(data, at, at, min(end, after, at + form.READ_BYTES), at + size, layout)
                if not starts:
                    return
                yield batch_of(base, path, starts, form.record_columns(data, at, starts, layout))
                at = reached
        else:
            for places, columns in form.open_stream(handle, kind):
                yield batch_of(base, path, places, columns)


def batch_of(base, path, places, columns):
    out = pd.DataFrame(columns)
    out["packet_id"] = base + np.array(places, dtype=np.int64)
    out["flags"] = out["flags"].astype("Int32")
    out["capture_path"] = path
    return pa.RecordBatch.from_pandas(out[CAPTURED.names], schema=to_arrow_schema(CAPTURED), preserve_index=False)


class CaptureMaps(DataSource):
    """One row per chunk of the capture files below a path, with the map of its record chains."""

    @classmethod
    def name(cls):
        return "capture_maps"

    def schema(self):
        return MAPS

    def reader(self, schema):
        return MapReader(dict(self.options))


class CapturePackets(DataSource):
    """The packets of indexed capture files."""

    @classmethod
    def name(cls):
        return "capture_packets"

    def schema(self):
        return CAPTURED

    def reader(self, schema):
        return PacketReader(dict(self.options))


class Captures:
    """Capture files below a path: their proved index, their packets and a summary per file."""

    def __init__(self, spark, path, chunk_bytes=CHUNK_BYTES, pattern=PATTERNS):
        spark.dataSource.register(CaptureMaps)
        spark.dataSource.register(CapturePackets)
        options = {"path": path, "chunkbytes": str(chunk_bytes), "pattern": pattern}
        maps = spark.read.format("capture_maps").options(**options).load()
        proved = maps.repartition("path").sortWithinPartitions("path", "chunk").mapInArrow(prove, INDEX)
        where = fresh_dir(spark, "capture-index")
        proved.write.mode("overwrite").parquet(where)
        self.index = spark.read.schema(INDEX).parquet(where)
        self.packets = spark.read.format("capture_packets").options(index=where, chunkbytes=str(chunk_bytes)).load()

    def summary(self):
        """capture_path, kind, bytes, packets, parsed (TCP or UDP), parse_errors, unread_bytes, problem: one row per file.

        A file that is no capture, is empty, ends inside a record or has a record of impossible length has its row
        too: `problem` names it, and unread_bytes counts what stands after its last whole record (of the unpacked
        stream, if the file is gzipped; of the file, if it is no capture at all).
        """
        usable = F.col("proto").isin(6, 17)
        counts = self.packets.groupBy("capture_path").agg(
            F.count(F.lit(1)).alias("packets"), F.count_if(usable).alias("parsed"), F.count_if(~usable).alias("parse_errors")
        )
        files = self.index.groupBy(F.col("path").alias("capture_path")).agg(
            F.max("kind").alias("kind"), F.max("length").alias("bytes"), F.sum("unread").alias("unread_bytes"),
            F.max("problem").alias("problem"),
        )
        n = [F.coalesce(c, F.lit(0)).alias(c) for c in ("packets", "parsed", "parse_errors")]
        return files.join(counts, "capture_path", "left").select("capture_path", "kind", "bytes", *n, "unread_bytes", "problem")


def read_captures(spark, path, chunk_bytes=CHUNK_BYTES, pattern=PATTERNS):
    """All packets of the capture files below a path, as raw packets with their file.

    What is neither TCP nor UDP over IPv4 keeps its protocol number, or 0 where it has none, so that unparsed packets
    can be counted. Ids follow the order of the files' paths and the place of the packet in its file; they are unique as long as the names of
    gzipped files end in `.gz`.
    """
    return Captures(spark, path, chunk_bytes, pattern).packets
