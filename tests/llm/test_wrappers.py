import html as entities
import random
import re

import pytest

from leakwatch.llm import wrappers
from leakwatch.llm.wrappers import Part, page_tree, page_wrapper, skeleton
from tests.llm import cases

SCHEMA = "page_id bigint, url string, html string, text string, host string, salt string, wrapper string"


def texts(spark, pages):
    rows = [(i, u, h, "clash", "x", "y", "z") for i, u, h in pages]
    found = wrappers.main_texts(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    return sorted(((r["page_id"], r["url"], r["text"]) for r in found), key=cases.key)


def text_of(page):
    tree = page_tree(page)
    return wrappers.main_text(tree, wrappers.decide(page_wrapper(tree), False))


def words(rng, n):
    return " ".join(rng.choice("alpha beta gamma delta é < & \" 日本 fin.".split()) for _ in range(n))


def generated(rng, site):
    """A page of one of four sites with everything around its text, and that text."""
    blocks = [words(rng, rng.randint(3, 40)) for _ in range(rng.randint(1, 7))]
    title = words(rng, 5)
    e = entities.escape
    around = lambda: e(words(rng, 4))
    menu = "<nav><ul>" + "".join(f"<li><a href='/{i}'>{around()}</a>" for i in range(rng.randint(2, 6))) + "</ul></nav>"
    paragraphs = "".join(f"<p>{e(b)}" + rng.choice(["", "</p>", "\n </p>"]) for b in blocks)
    if site == 0:
        body = f"{menu}<header><p>{around()}</p></header><article><h1>{e(title)}</h1>{paragraphs}<aside>{around()}</aside></article>"
        body += f"<section id=comments><article class='comment'><p>{e(words(rng, 60))}</p></article></section><footer>{around()}</footer>"
    elif site == 1:
        ad = f"<div class='ad-box ads'>{around()}</div>" if rng.random() < 0.5 else ""
        body = f"<div class=header>{around()}</div>{menu}<main><h1>{e(title)}</h1>{ad}{paragraphs}</main>"
        body += f"<div class=sidebar><p>{e(words(rng, 30))}</p></div><form><p>{around()}</p><input value='x>y'></form>"
    elif site == 2:
        body = f"<div id=top role=navigation>{around()}</div><div><h1>{e(title)}</h1><div>{paragraphs}</div></div>"
        body += f"<div class='cookie notice'><p>{e(words(rng, 90))}</p></div><div class=footer>{around()}</div>"
    else:
        body = f"<div class='entry-content with-sidebar'><h1>{e(title)}</h1>{paragraphs}</div><div class='related'>{around()}</div>"
    head = "<!doctype html><html><head><title>T &amp; t</title><style>p>a{}</style><script>var t='</p><article>';</script></head><body>"
    page = head + body + ("</body></html>" if rng.random() < 0.8 else "<!-- never closed <p>x</p>")
    return page, " ".join(" ".join(t.split()) for t in [title, *blocks])


def test_generated_sites(spark):
    rng = random.Random(3)
    pages, want = [], []
    for i in range(120):
        site = 0 if i < 60 else rng.randrange(4)
        page, text = generated(rng, site)
        url = f"https://Site{site}.example.org/{i}?q#f"
        pages.append((i, url, page))
        want.append((i, url, text))
    pages += [pages[0]] * 3
    want += [want[0]] * 3
    assert texts(spark, pages) == sorted(want, key=cases.key)


def test_odd_pages(spark):
    pages = [
        (1, None, None), (2, "no scheme", ""), (3, "http://a/", "just text &lt;b&gt; &#233;&nbsp;x"),
        (None, "http://a/", "<p>one<p>two"), (5, "http://b", "<"), (6, "http://b?x", "<!-- only"),
        (7, "http://c/", "<div>" * 3000 + "deep text" + "</div>" * 3000 + "<p>after"),
        (8, "http://c/", "<p>" + "long " * 200_000), (9, "http://d/", "<a href='never closed><p>x"),
    ]
    got = {r[0]: r[2] for r in texts(spark, pages)}
    assert got[1] == got[2] == got[6] == "" and got[3] == "just text <b> é x" and got[None] == "one two"
    assert got[7] == "deep text after" and got[8] == ("long " * 200_000).strip() and got[5] == "<"


def test_order_and_partitions_do_not_matter(spark):
    rng = random.Random(5)
    pages = [(i, f"http://h/{i}", generated(rng, rng.randrange(4))[0]) for i in range(40)]
    shuffled = random.Random(1).sample(pages, len(pages))
    assert texts(spark, pages) == texts(spark, shuffled)


@pytest.mark.parametrize("page,want", [
    ("<article>a<b>b</b>c<br>d<span class=ad>x</span></article>", "abc d"),
    ("<article><p>a<p>b<ul><li>c<li>d</ul><table><tr><td>e<td>f</table></article>", "a b c d e f"),
    ("<article><header><h1>t</h1></header><p>x</p><footer>f</footer></article>", "t x"),
    ("<head><meta a=b><body><article><p hidden>x</p><p style='display: none'>y</p><p>z</article>", "z"),
    ("<article><ul><li><a>m</a><li><a>n</a></ul><p>x</p></article>", "x"),
    ("<article>5 < 6 && 7 > 3</article>", "5 < 6 && 7 > 3"),
    ("<ARTICLE><P>A</P></ARTICLE>", "A"),
    ("<article><SCRIPT>if(a<b){'</p>'}</SCRIPT>x<textarea><p>y</textarea></article>", "x"),
])
def test_small_pages(page, want):
    assert text_of(page) == want


def shape(*pages):
    roots = [page_wrapper(page_tree(p)) for p in pages]
    for other in roots[1:]:
        wrappers.merge_into(roots[0], other)
    return roots[0]


def test_repeats_and_options_are_inferred():
    assert skeleton(shape("<ul><li>a<li>b<li>c</ul>")) == ";".join(["<ul<li+<#", ">", ">", ">", ""])
    root = shape("<h2>a</h2><p>x</p><h2>b</h2><p>y</p><hr><h2>c</h2><p>z</p>")
    assert [k.label for k in root.kids] == ["(h2 p)"] and root.kids[0].repeated
    root = shape("<h1>t</h1><p>x</p>", "<h1>t</h1><table><td>1</table><p>y</p>")
    assert [(k.label, k.optional) for k in root.kids] == [("h1", False), ("table", True), ("p", False)]
    constant, slot = root.kids[0].kids[0], root.kids[2].kids[0]
    assert constant.text is not None and slot.text is None and constant.pages == 2


def test_template_text_of_many_different_pages_goes(spark):
    def page(i):
        return f"<main><h1>Same title</h1><div>Share this page now</div><p>story number {i}</p><p>more {i}</p></main>"

    many = {r[0]: r[2] for r in texts(spark, [(i, "http://many/", page(i)) for i in range(20)])}
    assert many[7] == "Same title story number 7 more 7"
    few = texts(spark, [(i, "http://few/", page(i % 3)) for i in range(20)])
    assert few[0][2] == "Same title Share this page now story number 0 more 0"


def test_dump_and_load():
    root = wrappers.decide(shape("<article><p>a</p><p>b</p></article>", "<article><h1>t</h1></article>"), False)
    again = Part.load(root.dump())
    assert again.dump() == root.dump() and skeleton(again) == skeleton(root)


def test_empty_table(spark):
    frame = wrappers.main_texts(spark.createDataFrame([], SCHEMA))
    assert frame.columns == ["page_id", "url", "text", "n_chars"] and frame.count() == 0


def test_query_equals_plain_reading_of_the_article(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in wrappers.main_texts(pages).collect()}
    for row in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", row["html"], re.DOTALL)[1]
        plain = re.sub(r"</?(?:p|h1|br)>", " ", re.sub(r"</?b>", "", inner))
        assert got[row["page_id"]] == " ".join(entities.unescape(plain).split())


def plain_matches(left, right):
    """The table of longest common sequences, whole."""
    best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
    for i in range(len(left) - 1, -1, -1):
        for j in range(len(right) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if left[i] == right[j] else max(best[i + 1][j], best[i][j + 1])
    pairs, i, j = [], 0, 0
    while i < len(left) and j < len(right):
        if left[i] == right[j]:
            pairs.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return pairs


def test_long_sequences_are_aligned_as_short_ones():
    rng = random.Random(5)
    for most, kinds in [(12, 2), (12, 4), (700, 3), (700, 90)]:
        for _ in range(200 if most == 12 else 1):
            left, right = (["x", *(rng.randrange(kinds) for _ in range(rng.randint(most // 2 + 200 * (most > 12), most))), y] for y in "yz")
            assert wrappers.matches(left, right) == plain_matches(left, right)


def test_parts_of_long_pages_keep_their_places():
    """Siblings around a change at both ends of a page with over 500 of them."""
    same = [f"p.k{'abcdefghij'[i % 10] * (1 + i // 10 % 60)}" for i in range(600)]
    pairs = wrappers.matches(["a", *same, "b"], ["c", *same, "d"])
    assert pairs == [(i, i) for i in range(1, 601)]
