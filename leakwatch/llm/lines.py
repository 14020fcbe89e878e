"""Substring deduplication by line hashing.

A text is cut into lines, and lines into sentences, so that a passage is found where only
part of a line repeats. Short sentences are hashed in runs. Units are normalised and hashed,
digests are grouped over all documents, the earliest place of each digest stays, and the
others are removed with their places in the original text kept.
"""

import hashlib
import re

import pyarrow as pa
from pyspark.sql import functions as F

from leakwatch.llm import text as T

MIN_WORDS = 8
# A sentence ends with ., ! or ? before a gap; a line ends with a line feed.
_SENTENCE = re.compile(r"[^\n]+?(?:[.!?](?=[ \t\r\x0b\x0c])|(?=\n)|\Z)")
_LINE = re.compile(r"[^\n]+")
_PUNCTUATION = re.compile(r"[^\w]+")


def units(text, sentences=True, min_words=MIN_WORDS):
    """(start, end, words, digest as two signed 64-bit numbers) of the units of a text.

    Places are in code points. Normalising lower-cases, and turns runs of anything but
    letters, digits and underscores into one space. A sentence (or line) of `min_words`
    words is a unit. A shorter one repeats by chance, so it is hashed with its neighbours, over
    line ends too: the shortest run from it on and the shortest run up to it that have more
    than `min_words` words. Those runs depend on nothing outside them, so that any repeated
    run of whole sentences that long is covered by repeated units, whatever stands around it.
    Units are in order of start and end; they overlap, but none lies strictly inside another.
    """
    pieces, before = [], 0
    for found in (_SENTENCE if sentences else _LINE).finditer(text or ""):
        raw = found.group()
        bare = raw.lstrip()
        n = len(bare.split())
        normal = _PUNCTUATION.sub(" ", bare.lower()).strip()
        if normal:
            start = found.start() + len(raw) - len(bare)
            pieces.append((start, start + len(bare.rstrip()), n, before, normal))
        before += n
    runs = set()
    for i, piece in enumerate(pieces):
        if piece[2] >= min_words:
            runs.add((i, i))
            continue
        for way, stop in ((1, len(pieces)), (-1, -1)):
            n, j = 0, i
            while j != stop and n <= min_words:
                n += pieces[j][2]
                j += way
            if n > min_words:
                runs.add((min(i, j - way), max(i, j - way)))
    out = []
    for i, j in sorted(runs):
        normal = " ".join([p[4] for p in pieces[i : j + 1]])
        digest = hashlib.blake2b(normal.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        n = pieces[j][3] + pieces[j][2] - pieces[i][3]
        out.append((pieces[i][0], pieces[j][1], n, int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)))
    return out


UNIT = "array<struct<start:int,end:int,words:int,d1:bigint,d2:bigint>>"


def with_units(docs, keep, sentences=True, min_words=MIN_WORDS):
    """Columns `keep` and `_units`, the units of `text` in order."""
    kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("words", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64())])

    def setup():
        def make(texts):
            found = [units(t, sentences, min_words) for t in texts]
            offsets, flat = [0], []
            for f in found:
                flat += f
                offsets.append(len(flat))
            columns = list(zip(*flat)) if flat else [()] * 5
            values = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], fields=list(kind))
            return (pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values),)

        return make

    return T.map_texts(docs, keep, f"_units {UNIT}", setup)


def removals(docs, sentences=True, min_words=MIN_WORDS, row_id=None):
    """Units to remove: doc_id, unit, start, end, n_words, digest, first_doc_id, first_start, copies.

    `unit` counts the hashed units of a text from 0; start and end are code point offsets in
    the original text. Places are ranked by (doc_id, row, unit), null ids last; the first
    place of a digest stays, so a repeat inside one text is removed as well. Spans of runs
    overlap; a word that is removed always has an earlier copy that stays. Texts that are
    null, empty or without a unit of `min_words` words give no row. Repeated rows are
    different rows: all but one lose their units. `copies` is the number of places in all.
    Column `row_id` of docs, if one is named, tells rows apart and is returned too. Other
    columns are not read.

    Scale: the text is read once, and 40 bytes per unit are written to the shared folder.
    Digests are counted with partial sums before their shuffle; only those found twice go
    on, joined as two written tables, so that Spark can split a line found everywhere.
    """
    row = F.col(row_id) if row_id else F.monotonically_increasing_id()
    rows = docs.select("doc_id", "text", row.alias("_row"))
    flat = with_units(rows, ["doc_id", "_row"], sentences, min_words).select(
        "doc_id", "_row", F.posexplode("_units").alias("unit", "u")
    )
    places = T.staged(flat.select("doc_id", "_row", "unit", "u.*"), "line-units")
    rank = F.struct(
        F.col("doc_id").isNull().alias("blank"),
        F.col("doc_id").alias("id"),
        F.col("_row").alias("row"),
        F.col("unit").alias("unit"),
        F.col("start").alias("start"),
    )
    firsts = (
        places.groupBy("d1", "d2")
        .agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )
    firsts = T.staged(firsts, "line-firsts")
    later = (F.col("_row") != F.col("first.row")) | (F.col("unit") != F.col("first.unit"))
    digest = F.lower(F.concat(F.lpad(F.hex("d1"), 16, "0"), F.lpad(F.hex("d2"), 16, "0")))
    return places.join(firsts, ["d1", "d2"]).where(later).select(
        "doc_id",
        *([F.col("_row").alias(row_id)] if row_id else []),
        "unit",
        "start",
        "end",
        F.col("words").alias("n_words"),
        digest.alias("digest"),
        F.col("first.id").alias("first_doc_id"),
        F.col("first.start").alias("first_start"),
        "copies",
    )


def drop_repeats(docs, sentences=True, min_words=MIN_WORDS):
    """`docs` with removed units cut from `text`, and `removed`: their (start, end) in the original.

    Spans may overlap; what any of them covers is cut.
    A column `removed` of docs gives way to it.
    All rows stay, an emptied text as an empty one. What is between units is not touched.
    """
    names = docs.columns
    kept = [f"_c{i}" for i in range(len(names))]
    numbered = docs.select(
        *[F.col(f"`{n}`").alias(c) for n, c in zip(names, kept)],
        F.col("doc_id").alias("doc_id"),
        F.col("text").alias("text"),
        F.monotonically_increasing_id().alias("_row"),
    )
    rows = T.staged(numbered, "line-rows")
    found = removals(rows, sentences, min_words, row_id="_row")
    spans = found.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_spans"))
    joined = rows.join(T.staged(spans, "line-spans"), "_row", "left")
    spans = F.coalesce("_spans", F.array().cast("array<struct<start:int,end:int>>"))
    text = F.col("text")
    parts = F.aggregate(
        spans,
        F.struct(F.lit("").alias("t"), F.lit(0).alias("pos")),
        lambda s, x: F.struct(
            F.concat(s["t"], F.substr(text, s["pos"] + 1, F.greatest(x["start"] - s["pos"], F.lit(0)))).alias("t"), x["end"].alias("pos")
        ),
        lambda s: F.concat(s["t"], F.substr(text, s["pos"] + 1)),
    )
    clean = F.when(F.col("_spans").isNull(), text).otherwise(parts)
    return joined.select(
        *[(clean if n == "text" else F.col(c)).alias(n) for n, c in zip(names, kept) if n != "removed"],
        spans.alias("removed"),
    )
