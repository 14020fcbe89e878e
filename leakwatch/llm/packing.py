"""Token ids in packed rows.

Texts become token ids, overlong ones are cut without loss, and the pieces are packed into
rows of fixed length by best fit decreasing: longest piece first, each into the open row
with the least room that holds it. The row is found in a segment tree over capacities.
"""

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from leakwatch.llm import text as T

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
END = 50256  # free in the vocabulary: the end of a document
LENGTH = 2048
SHARD_TOKENS = 1 << 20
CACHE_WORDS = 200_000
# Before a space that follows no white space, every pattern piece ends: both sides can be
# encoded on their own.
_CUT = re.compile(r"(?<=\S)(?= )")


class Encoder:
    """Text to token ids, with a bounded store of pieces already encoded."""

    def __init__(self, path=VOCABULARY, pattern=None, cache_words=CACHE_WORDS):
        import tiktoken

        if pattern is None:
            from public_tokenizers import PATTERN as pattern
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.whole = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.room = cache_words
        self.known = {}

    def __call__(self, text):
        known, out = self.known, []
        for piece in _CUT.split(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.whole.encode_ordinary(piece)
                if len(piece) < 24 and len(known) < self.room:
                    known[piece] = ids
            out += ids
        return out


class Capacities:
    """Counts of open rows by room left, as a segment tree: finds the least room of at least n."""

    def __init__(self, most):
        self.base = 1 << max(1, most.bit_length())
        self.count = [0] * (2 * self.base)
        self.rows = {}

    def _add(self, room, change):
        i = room + self.base
        while i:
            self.count[i] += change
            i >>= 1

    def put(self, room, row):
        self.rows.setdefault(room, []).append(row)
        self._add(room, 1)

    def take(self, least):
        """(row, room) with the least room of at least `least`, or None."""
        i = least + self.base
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.base:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.base
        row = self.rows[room].pop()
        self._add(room, -1)
        return row, room


def best_fit(sizes, length):
    """Row number of each piece; rows hold at most `length`. Longest first, ties in order."""
    place, open_rows, rows = np.zeros(len(sizes), np.int64), Capacities(length), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = open_rows.take(sizes[i])
        row, room = found if found else (rows, length)
        rows += not found
        place[i] = row
        if room > sizes[i]:
            open_rows.put(room - sizes[i], row)
    return place, rows


def pack(shard, length, pad=END):
    """Pack one shard: (id matrix, per row the segments (document, first token, tokens)).

    shard: [(document, ids)]. An overlong document is cut into pieces of `length` tokens
    and a rest; nothing is lost or repeated.
    """
    pieces = [(d, at, ids[at : at + length]) for d, ids in shard for at in range(0, len(ids), length)]
    place, rows = best_fit([len(ids) for _, _, ids in pieces], length)
    matrix, segments, used = np.full((rows, length), pad, np.int32), [[] for _ in range(rows)], [0] * rows
    for (d, at, ids), row in zip(pieces, place.tolist()):
        matrix[row, used[row] : used[row] + len(ids)] = ids
        segments[row].append((d, at, len(ids)))
        used[row] += len(ids)
    return matrix, segments


PACKED = (
    "shard bigint, row int, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, "
    "doc_ids array<bigint>, doc_starts array<int>"
)


def packed_rows(docs, length=LENGTH, shard_tokens=SHARD_TOKENS, vocabulary=VOCABULARY):
    """Packed rows: shard, row, n_tokens, input_ids, position_ids, cu_seqlens, doc_ids, doc_starts.

    input_ids: `length` little-endian 32-bit ids, padded with the end id; the rows of a
    shard in order are its id matrix. position_ids: as many positions, written alike, from 0
    in every segment and in the padding. cu_seqlens: 0 and the end of each segment, where
    positions reset. doc_ids: the document of each segment, null for a null id.
    doc_starts: the place of a segment's first token in its document, above 0 for the
    pieces of a cut one. Every document ends with the end id, so a null or empty text is
    that id alone, and its ids joined over its segments are its text again. Repeated rows
    are packed each. Other columns are not read; an empty table gives no rows.

    Scale: no shuffle. A task packs what it reads in shards of about `shard_tokens`
    tokens, so its memory is a shard and an Arrow batch. A text beyond that is a shard of its
    own. Shards are numbered by task and order, and a repeated task repeats them.
    """
    kind = pa.schema(
        [
            ("shard", pa.int64()),
            ("row", pa.int32()),
            ("n_tokens", pa.int32()),
            ("input_ids", pa.binary()),
            ("position_ids", pa.binary()),
            ("cu_seqlens", pa.list_(pa.int32())),
            ("doc_ids", pa.list_(pa.int64())),
            ("doc_starts", pa.list_(pa.int32())),
        ]
    )

    def run(batches):
        from pyspark import TaskContext

        encode = Encoder(vocabulary)
        number = TaskContext.get().partitionId() << 32
        shard, size = [], 0

        def close():
            matrix, segments = pack(shard, length)
            ends = [np.cumsum([0] + [n for _, _, n in s]).tolist() for s in segments]
            rows = len(segments)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number] * rows, pa.int64()),
                    pa.array(range(rows), pa.int32()),
                    pa.array([e[-1] for e in ends], pa.int32()),
                    pa.array([r.astype("<i4").tobytes() for r in matrix], pa.binary()),
                    pa.array([position_ids(e, length).astype("<i4").tobytes() for e in ends], pa.binary()),
                    pa.array(ends, pa.list_(pa.int32())),
                    pa.array([[d for d, _, _ in s] for s in segments], pa.list_(pa.int64())),
                    pa.array([[at for _, at, _ in s] for s in segments], pa.list_(pa.int32())),
                ],
                schema=kind,
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "")
                ids.append(END)
                shard.append((doc_id, ids))
                size += len(ids)
                if size >= shard_tokens:
                    yield close()
                    shard, size, number = [], 0, number + 1
        if shard:
            yield close()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PACKED)


def position_ids(cu_seqlens, length=LENGTH):
    """Positions of a packed row from its segment ends: they restart at 0 in every segment."""
    out = np.arange(length)
    for start, end in zip(cu_seqlens, cu_seqlens[1:]):
        out[start:end] -= start
    out[cu_seqlens[-1] :] -= cu_seqlens[-1]
    return out


def write_shards(packed, path):
    """Write packed rows as Parquet, rows of a shard together and in order."""
    packed.sortWithinPartitions("shard", "row").write.mode("overwrite").parquet(path)
