import cases
from leakwatch.llm import lines as L


def brute(data, **options):
    """Spans to remove by row number."""
    order = sorted(range(len(data)), key=lambda i: (data[i][0] is None, data[i][0] or 0, i))
    seen, out = set(), {}
    for i in order:
        for start, end, _, d1, d2 in L.units(data[i][1], **options):
            if (d1, d2) in seen:
                out.setdefault(i, []).append((start, end))
            seen.add((d1, d2))
    return out


def data():
    shared = "this sentence is shared by several of the documents, word for word. "
    rows = cases.rows()
    extra = [(300 + i, cases.prose(30, 900 + i) + "\n" + "Own start of a line number %d. " % i + shared.upper() * (i % 2) + shared + "and an own end of it", "en", "s0", 1, 5, "c", 0.1, "n") for i in range(4)]
    return rows + extra


def test_removed_units_equal_brute_force(spark):
    rows = data()
    for sentences in (True, False):
        got = L.drop_repeats(cases.frame(spark, rows).coalesce(1), sentences=sentences).collect()
        want = brute(rows, sentences=sentences)
        by_text = {}
        for i, r in enumerate(rows):
            spans = want.get(i, [])
            text = r[1]
            if spans:
                text = "".join(text[a:b] for a, b in zip([0] + [e for _, e in spans], [s for s, _ in spans] + [len(text)]))
            by_text.setdefault((r[0], text, tuple(spans)), []).append(i)
        have = {}
        for r in got:
            have.setdefault((r.doc_id, r.text, tuple((x.start, x.end) for x in r.removed)), []).append(1)
        assert {k: len(v) for k, v in have.items()} == {k: len(v) for k, v in by_text.items()}


def test_removals_name_the_place_that_stays(spark):
    rows = data()
    got = L.removals(cases.frame(spark, rows)).collect()
    texts = {r[0]: r[1] for r in rows}
    assert {"doc_id", "start", "end", "first_doc_id", "first_start", "copies", "n_words"} <= set(got[0].asDict())
    norm = lambda t: L._PUNCTUATION.sub(" ", t.lower()).strip()
    for r in got:
        if r.doc_id is not None and r.first_doc_id is not None:
            here, there = texts[r.doc_id][r.start : r.end], texts[r.first_doc_id][r.first_start :]
            assert norm(there).startswith(norm(here))
    assert {r.doc_id for r in got if r.doc_id and r.doc_id >= 301} == {301, 302, 303}


def test_short_units_stay():
    assert L.units("one two three. four five six.\nseven eight") == []
    assert len(L.units("a b c d e f g h. i j k l m n o p q", min_words=8)) == 2


def test_offsets_are_code_points_of_the_original():
    text = "  Ünï 日本 three four five six seven eight nine!  next words go on for some more time here"
    for start, end, n, *_ in L.units(text):
        assert text[start:end] == text[start:end].strip() and len(text[start:end].split()) == n


def test_empty_table(spark):
    empty = cases.frame(spark, [])
    assert L.removals(empty).count() == 0 and L.drop_repeats(empty).count() == 0


def short_sentences(n, seed, gap):
    """n words in sentences of 2 to 6 words."""
    words, out, k = cases.prose(n, seed).replace(".", "").split(), [], 0
    while words:
        size = 2 + (seed + k) % 5
        out.append(" ".join(words[:size]) + ".")
        words, k = words[size:], k + 1
    return "".join(s + (gap if i % 3 else " ") for i, s in enumerate(out))


def windows_seen_before(before, text, size=50):
    """Runs of `size` words of a text that stand in one of the texts before, by plain comparison."""
    bare = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
    known = {tuple(w[i : i + size]) for w in map(bare, before) for i in range(len(w) - size + 1)}
    mine = bare(text)
    return [w for i in range(len(mine) - size + 1) if (w := tuple(mine[i : i + size])) in known]


def test_passages_of_short_sentences_and_short_lines_are_found(spark):
    rows = []
    for k, gap in enumerate((" ", "\n", "  ")):
        passage = short_sentences(70, 40 + k, gap)
        for i in range(3):
            head, tail = cases.prose(40, 100 * k + 7 * i + 500), cases.prose(33, 100 * k + 7 * i + 501)
            rows.append((10 * k + i, f"{head}. {passage}\n{tail}", "en", "s", 1, 5, "c", 0.1, "n"))
    got = {r.doc_id: r.text for r in L.drop_repeats(cases.frame(spark, rows)).collect()}
    texts = {r[0]: r[1] for r in rows}
    for doc, text in texts.items():
        before = [t for d, t in texts.items() if d < doc]
        assert bool(windows_seen_before(before, text)) == (doc % 10 > 0)
        assert windows_seen_before(before, got[doc], 9) == []
        # The text of its own is whole, and the first place stays.
        assert len(got[doc].split()) == len(text.split()) - 70 * (doc % 10 > 0)


def test_a_removed_run_leaves_an_earlier_copy_of_its_words(spark):
    rows = [(i, t, "en", "s", 1, 5, "c", 0.1, "n") for i, t in enumerate(["a b c.\n" * 9 + "d e f g h.", "d e f g h.\na b c. a b c. a b c. x y."])]
    got = {r.doc_id: r.text.split() for r in L.drop_repeats(cases.frame(spark, rows)).collect()}
    assert got[0] == "a b c. d e f g h.".split() and got[1][-2:] == ["x", "y."]
