import random

import numpy as np
import pytest

import cases
from leakwatch.llm import packing as P

LENGTH = 64


def rebuilt(rows, length=LENGTH):
    """Token ids by segment start, of every document piece."""
    out = []
    for r in rows:
        ids = np.frombuffer(r.input_ids, "<i4")
        assert len(ids) == length and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens <= length
        assert (ids[r.n_tokens :] == P.END).all()
        for doc, at, a, b in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            out.append((doc, at, ids[a:b].tolist()))
    return out


def test_round_trip_is_exact(spark):
    rows = P.packed_rows(cases.frame(spark), length=LENGTH, shard_tokens=500).collect()
    whole = P.Encoder().whole
    pieces = {}
    for doc, at, ids in rebuilt(rows):
        pieces.setdefault(doc, []).append((at, ids))
    want = {}
    for r in cases.rows():
        want.setdefault(r[0], []).append(r[1] or "")
    assert set(pieces) == set(want)
    for doc, texts in want.items():
        if len(texts) == 1:
            ids = [t for _, part in sorted(pieces[doc]) for t in part]
            assert ids[-1] == P.END and whole.decode(ids[:-1]) == texts[0]
            assert ids[:-1] == whole.encode_ordinary(texts[0])
        assert sum(len(p) for _, p in pieces[doc]) == sum(len(whole.encode_ordinary(t)) + 1 for t in texts)


@pytest.mark.parametrize("text", ["", " ", "a", "a  b", " a\n b\t\tc ", "x\x1c y\x85 z\xa0 w", "don't  stop", "日本 語 ①² é", "a \n\n b   c\n"])
def test_pieces_encode_as_the_whole(text):
    encode = P.Encoder()
    assert encode(text) == encode.whole.encode_ordinary(text)
    assert encode(text) == encode.whole.encode_ordinary(text)  # from the store


def test_random_texts_encode_as_the_whole():
    rng, encode = random.Random(4), P.Encoder(cache_words=50)
    for _ in range(300):
        text = "".join(rng.choice("ab é. \n\t!'s1日\x1c\xa0 ") for _ in range(rng.randrange(60)))
        assert encode(text) == encode.whole.encode_ordinary(text)


def brute_fit(sizes, length):
    rooms, place = [], [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fit = [(room, r) for r, room in enumerate(rooms) if room >= sizes[i]]
        if fit:
            r = min(fit)[1]
        else:
            rooms.append(length)
            r = len(rooms) - 1
        rooms[r] -= sizes[i]
        place[i] = r
    return place, rooms


def test_best_fit_takes_the_least_room():
    rng = random.Random(9)
    for length in (1, 7, 64, 100):
        sizes = [rng.randint(1, length) for _ in range(200)]
        place, rows = P.best_fit(sizes, length)
        _, rooms = brute_fit(sizes, length)
        fill = np.bincount(place, sizes, minlength=rows)
        assert rows == len(rooms) and fill.max() <= length
        assert sorted(length - fill) == sorted(rooms)


def test_positions_restart_with_every_segment():
    assert P.position_ids([0, 3, 5], 7).tolist() == [0, 1, 2, 0, 1, 0, 1]


def test_empty_table(spark):
    assert P.packed_rows(cases.frame(spark, [])).count() == 0


def test_written_shards_read_back_in_order_with_their_positions(spark, tmp_path):
    import pyarrow.parquet as pq

    packed = P.packed_rows(cases.frame(spark), length=LENGTH, shard_tokens=500)
    P.write_shards(packed, f"file://{tmp_path}/out")
    back = []
    for file in sorted((tmp_path / "out").glob("*.parquet")):
        rows = pq.read_table(file).to_pylist()
        assert [(r["shard"], r["row"]) for r in rows] == sorted((r["shard"], r["row"]) for r in rows)
        back += rows
    key = lambda r: (r["shard"], r["row"])
    assert sorted(back, key=key) == sorted((r.asDict() for r in packed.collect()), key=key)
    for r in back:
        want = [i for a, b in zip(r["cu_seqlens"], [*r["cu_seqlens"][1:], LENGTH]) for i in range(b - a)]
        want += list(range(LENGTH - len(want)))
        assert len(r["position_ids"]) == len(r["input_ids"]) == 4 * LENGTH
        assert np.frombuffer(r["position_ids"], "<i4").tolist() == want
