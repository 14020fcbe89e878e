"""Main text of web pages, by wrappers inferred from the pages of each host.

A wrapper is a union-free regular expression over tags and text slots: a sequence of parts, each
of which may be optional or repeated. A page becomes one by folding neighbouring siblings, or
groups of siblings, that repeat. Wrappers are aligned part by part: parts that match are merged,
others become optional, a text that differs between pages becomes a slot.

Pages of equal structure are merged where they are read; one wrapper per host then comes out of
two sorted streams of partial wrappers, so a host may hold any share of the pages. Which parts
hold the main text is decided once per wrapper, from its names, slots and link shares. Pages meet
the wrapper of their host in a shuffle by host and a salt, and each text is taken from the parts
of the page that match main parts.
"""

import functools
import hashlib
import html
import json
import math
import re

import pyarrow as pa
from pyspark.sql import functions as F

from leakwatch.llm.text import staged

# Pages of a host are dealt to this many shuffle keys; 32 at most, as they are bits of an int.
SALTS = 32
# Partial wrappers of a host are first merged in this many groups.
BUCKETS = 16
HELD_WRAPPERS = 2_000
LONGEST_GROUP = 4
# Labels of a sequence whose places are held as bits while it is aligned.
HELD_MASKS = 256
# Distinct page texts a host needs before a text found on all its pages counts as part of the template.
LEAST_VARIED = 16
LINK_SHARE = 0.8
# Blocks nested deeper than this stay part of the block at this depth.
DEEPEST = 150

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr math mi mn mo mrow msub msup mfrac msqrt mtext".split()
)
SILENT = frozenset("script style noscript template textarea title iframe object svg canvas select head".split())
HEAD_TAGS = frozenset("object basefont bgsound noframes".split())
CLOSED_BY_BLOCK = "p"
# An opening tag of the first kind closes an open one of the second, unless a tag of the third stands between.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SIDE_TAGS = frozenset("nav aside footer form button dialog menu fieldset".split())
SIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer comment comments commentlist disqus reply replies respond cookie cookies "
    "consent gdpr notice alert popup modal overlay newsletter subscribe signup share sharing social related "
    "recommended recommendations widget toolbar pagination pager login search skip complementary contentinfo".split()
)
# Class names such as `with-sidebar` describe a page, not its part.
LAYOUT_NAMES = frozenset("with has no without".split())
KEPT_TAGS = frozenset("html body article main".split())
MAIN_NAMES = ("articlebody", "article", "entry", "post", "story", "content")

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|svg|canvas|select)\b[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|</(?P<close>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|<(?P<open>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<odd>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.IGNORECASE)
NAME = re.compile(r"[a-z]+")


class Part:
    """A part of a page or of a wrapper: a tag, a group of siblings `()`, or a text `#`."""

    __slots__ = ("label", "kids", "text", "optional", "repeated", "pages", "chars", "links", "main", "folded")

    def __init__(self, label, kids=None, text=None, links=0):
        self.label, self.kids, self.text, self.links = label, kids if kids is not None else [], text, links
        self.optional = self.repeated = self.main = False
        self.pages, self.chars, self.folded = 1, 0, None

    def dump(self):
        flags = self.optional + 2 * self.repeated + 4 * self.main
        return [self.label, flags, self.text, self.pages, self.chars, self.links, [k.dump() for k in self.kids]]

    @staticmethod
    def load(row):
        part = Part(row[0], [Part.load(k) for k in row[6]], row[2], row[5])
        part.optional, part.repeated, part.main = bool(row[1] & 1), bool(row[1] & 2), bool(row[1] & 4)
        part.pages, part.chars = row[3], row[4]
        return part


def label_of(tag, attrs):
    """Tag with the names in its class, id and role, digits left out; `hidden` is one of them."""
    names = set()
    for key, value in ATTRIBUTE.findall(attrs) if attrs and not attrs.isspace() else ():
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "style":
            value = "hidden" if "display:none" in value.replace(" ", "") else ""
        elif key == "hidden" or (key == "aria-hidden" and value == "true"):
            value = "hidden"
        names.update(NAME.findall(value) if key != "aria-hidden" or value == "hidden" else ())
    return f"{tag}.{'.'.join(sorted(names))}" if names else tag


def names_of(label):
    tag, _, names = label.partition(".")
    return tag, names.split(".") if names else []


def is_side(label, in_article):
    """Whether a tag by its name or classes holds something other than main text."""
    tag, names = names_of(label)
    if tag in SILENT:
        return True
    named = not SIDE_NAMES.isdisjoint(names) and LAYOUT_NAMES.isdisjoint(names)
    if tag in KEPT_TAGS:
        return "hidden" in names or (tag == "article" and named)
    if tag in SIDE_TAGS or (tag == "header" and not in_article):
        return True
    if not in_article and "header" in names and tag not in HEADINGS:
        return True
    return "hidden" in names or named


class Builder:
    """Tree of block tags with their texts from a stream of tokens."""

    def __init__(self):
        self.root = Part("")
        self.open = [self.root]
        self.tags = [""]
        self.texts, self.links, self.anchors = [], 0, 0

    def flush(self):
        if self.texts:
            text = " ".join("".join(self.texts).split())
            if text:
                self.open[-1].kids.append(Part("#", text=text, links=min(self.links, len(text))))
            self.texts, self.links = [], 0

    def add_text(self, raw):
        text = html.unescape(raw) if "&" in raw else raw
        self.texts.append(text)
        if self.anchors:
            self.links += len(text)

    def pop_to(self, at):
        self.flush()
        self.anchors = 0
        del self.open[at:], self.tags[at:]

    def start(self, tag, attrs):
        if tag in VOID:
            if tag == "br":
                self.texts.append(" ")
            elif tag == "hr":
                self.flush()
            return
        label = label_of(tag, attrs)
        if tag in INLINE and (label == tag or not is_side(label, True)):
            self.anchors += tag == "a"
            return
        self.flush()
        if "head" in self.tags and tag not in HEAD_TAGS:
            self.pop_to(self.tags.index("head"))
        if tag in IMPLIED:
            closes, walls = IMPLIED[tag]
            for at in range(len(self.tags) - 1, 0, -1):
                if self.tags[at] in closes:
                    self.pop_to(at)
                    break
                if self.tags[at] in walls:
                    break
        elif self.tags[-1] == CLOSED_BY_BLOCK and tag not in INLINE:
            self.pop_to(len(self.tags) - 1)
        if len(self.open) < DEEPEST:
            part = Part(label)
            self.open[-1].kids.append(part)
        else:
            part = self.open[-1]
        self.open.append(part)
        self.tags.append(tag)

    def end(self, tag):
        if tag in INLINE and tag not in self.tags:
            if tag == "a" and self.anchors:
                self.anchors -= 1
            return
        for at in range(len(self.tags) - 1, 0, -1):
            if self.tags[at] == tag:
                self.pop_to(at)
                break


def page_tree(page):
    """Tree of the block tags of a page; tags left open end with their parent."""
    build = Builder()
    at = 0
    for token in TOKEN.finditer(page):
        if token.start() > at:
            build.add_text(page[at : token.start()])
        at = token.end()
        kind = token.lastgroup
        if kind == "close":
            build.end(token["close"].lower())
        elif kind == "attrs" or kind == "open":
            build.start(token["open"].lower(), token["attrs"])
        elif kind == "odd":
            build.start(token["odd"].lower(), "")
    build.add_text(page[at:])
    build.pop_to(1)
    return build.root


def digest(text):
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=6).digest(), "big")


def merge_into(kept, other):
    """Merge a part into another of the same label."""
    kept.optional |= other.optional
    kept.repeated |= other.repeated
    kept.pages += other.pages
    kept.chars += other.chars
    kept.links += other.links
    if kept.text != other.text:
        kept.text = None
    kept.kids = merge_sequences(kept.kids, other.kids)
    other.folded = kept
    return kept


def common_rows(left, right):
    """Function from i to the bits of row i of the longest common sequences of left[i:] and right.

    Bit c of a row, from the end of `right`, is 0 where one more label of it lengthens the sequence. Rows are whole numbers
    of len(right) bits, made one from the next by Hyyro's rule; every sqrt(len(left))-th is kept and the others
    of one stretch are made again on the way back.
    """
    size = len(right)
    full = (1 << size) - 1
    places = {}
    for place, label in enumerate(reversed(right)):
        places.setdefault(label, []).append(place)

    @functools.lru_cache(HELD_MASKS)
    def mask(label):
        bits = bytearray(size // 8 + 1)
        for place in places.get(label, ()):
            bits[place >> 3] |= 1 << (place & 7)
        return int.from_bytes(bits, "little")

    def below(row, label):
        hit = row & mask(label)
        return (row + hit | row - hit) & full

    step = math.isqrt(len(left)) + 1
    row, kept = full, {len(left): full}
    for i in range(len(left) - 1, -1, -1):
        row = below(row, left[i])
        if i % step == 0:
            kept[i] = row
    stretch = {}

    def row_of(i):
        if i in kept:
            return kept[i]
        if i not in stretch:
            stretch.clear()
            at = min(len(left), (i // step + 1) * step)
            made = kept[at]
            while at > i // step * step + 1:
                at -= 1
                made = stretch[at] = below(made, left[at])
        return stretch[i]

    return row_of


def matches(left, right):
    """Pairs of places of a longest common sequence of labels."""
    low, most = 0, min(len(left), len(right))
    while low < most and left[low] == right[low]:
        low += 1
    tail = 0
    while tail < most - low and left[-1 - tail] == right[-1 - tail]:
        tail += 1
    rows, columns = len(left) - low - tail, len(right) - low - tail
    pairs = [(i, i) for i in range(low)]
    if rows and columns:
        row_of = common_rows(left[low : len(left) - tail], right[low : len(right) - tail])

        def longest(i, j):
            """Length of the longest common sequence from row i and column j on."""
            return columns - j - (row_of(i) & ((1 << (columns - j)) - 1)).bit_count()

        i = j = 0
        while i < rows and j < columns:
            if left[low + i] == right[low + j]:
                pairs.append((low + i, low + j))
                i, j = i + 1, j + 1
                continue
            here, down = longest(i, j), longest(i + 1, j)
            # Down as long as nothing is lost, else right.
            i, j = (i + 1, j) if down == here else (i, j + 1)
    return pairs + [(len(left) - t, len(right) - t) for t in range(tail, 0, -1)]


def merge_sequences(left, right):
    """Align two sequences of parts: matching ones are merged, others become optional."""
    if not left and not right:
        return left
    out, i, j = [], 0, 0
    for a, b in matches([p.label for p in left], [p.label for p in right]) + [(len(left), len(right))]:
        for part in left[i:a] + right[j:b]:
            part.optional = True
            out.append(part)
        if a < len(left):
            out.append(merge_into(left[a], right[b]))
        i, j = a + 1, b + 1
    return out


def group_of(parts):
    if len(parts) == 1:
        return parts[0]
    group = Part("(" + " ".join(p.label for p in parts) + ")", parts)
    group.chars, group.links = sum(p.chars for p in parts), sum(p.links for p in parts)
    return group


def fold_repeats(parts):
    """Fold runs of equal neighbours, then of equal groups of neighbours, into repeated parts."""
    for size in range(1, LONGEST_GROUP + 1):
        out, i = [], 0
        labels = [p.label for p in parts]
        while i < len(parts):
            j = i + size
            while labels[i : i + size] == labels[j : j + size] and j + size <= len(parts):
                j += size
            if j == i + size:
                out.append(parts[i])
                i += 1
                continue
            first = group_of(parts[i : i + size])
            for at in range(i + size, j, size):
                merge_into(first, group_of(parts[at : at + size]))
            # Occurrences inside one page, not pages.
            first.repeated, first.pages = True, 1
            out.append(first)
            i = j
        parts = out
    return parts


def page_wrapper(part):
    """Wrapper of one page; every part of the page points to the part it became."""
    if part.label == "#":
        made = Part("#", text=digest(part.text), links=part.links)
        made.chars = len(part.text)
    else:
        made = Part(part.label, fold_repeats([page_wrapper(k) for k in part.kids]))
        made.chars, made.links = sum(k.chars for k in made.kids), sum(k.links for k in made.kids)
    part.folded = made
    return made


def skeleton(part):
    """Structure of a wrapper without its texts."""
    inner = "".join(map(skeleton, part.kids))
    return f"{part.label}{'+' if part.repeated else ''}{'?' if part.optional else ''}{'<' + inner + '>' if inner else ''};"


def paragraph_chars(part):
    """Characters outside links that stand in a part or its direct text blocks."""
    total = 0
    for kid in part.kids:
        if kid.label == "#":
            total += kid.chars - kid.links
        elif kid.label.startswith("(") or names_of(kid.label)[0] in ("p", "pre", "blockquote", *HEADINGS):
            total += sum(k.chars - k.links for k in kid.kids if k.label == "#")
            if kid.label.startswith("("):
                total += paragraph_chars(kid)
    return total


def walk(part, in_article=False):
    """All parts outside those that hold something else, with whether they lie in an article."""
    yield part, in_article
    inside = in_article or names_of(part.label)[0] in ("article", "main")
    for kid in part.kids:
        if kid.label != "#" and not is_side(kid.label, inside):
            yield from walk(kid, inside)


def outermost(parts):
    inner = {id(k) for p in parts for k, _ in walk(p) if k is not p}
    return [p for p in parts if id(p) not in inner]


def main_roots(root):
    """Parts of a wrapper that hold the main text: articles, else a main element, else one named like
    it, else the one with the most characters in paragraphs."""
    seen = [p for p, _ in walk(root)]
    named = {}
    for part in seen:
        if part.chars and part is not root:
            tag, names = names_of(part.label)
            if tag not in HEADINGS:
                for name in (tag, *names):
                    named.setdefault(name, []).append(part)
    for key in ("article", "main", *MAIN_NAMES):
        found = outermost(named.get(key, []))
        if found:
            most = max(p.chars for p in found)
            return [p for p in found if 5 * p.chars >= most or p.links < LINK_SHARE * p.chars]
    best = max(seen, key=paragraph_chars)
    if not paragraph_chars(best):
        return [root]
    within = {id(p) for p, _ in walk(best)}
    return [p for p in seen if names_of(p.label)[0] == "h1" and id(p) not in within] + [best]


def decide(root, varied):
    """Mark the parts of a wrapper that hold main text. A text that all of many different pages
    share is part of the template, unless it is a heading."""

    def mark(part, heading, repeated):
        part.main = True
        heading = heading or names_of(part.label)[0] in HEADINGS
        repeated = repeated or part.repeated
        for kid in part.kids:
            if kid.label == "#":
                template = varied and kid.text is not None and kid.pages == root.pages and not repeated and not heading
                kid.main = not template
            elif not is_side(kid.label, True):
                listed = names_of(kid.label)[0] in ("ul", "ol", "div") and any(k.repeated for k in kid.kids)
                if not (listed and kid.links > LINK_SHARE * kid.chars):
                    mark(kid, heading, repeated)

    for part in main_roots(root):
        mark(part, False, False)
    return root


def match_roles(parts, wrapper_parts, inherited):
    """Role of every part of a page wrapper (by identity), from the parts of its host's wrapper."""
    roles = {}
    pairs = dict(matches([p.label for p in parts], [p.label for p in wrapper_parts]))
    for i, part in enumerate(parts):
        if i in pairs:
            other = wrapper_parts[pairs[i]]
            roles[id(part)] = other.main
            roles.update(match_roles(part.kids, other.kids, other.main))
        else:
            role = inherited and (part.label == "#" or not is_side(part.label, True))
            roles[id(part)] = role
            roles.update(match_roles(part.kids, [], role))
    return roles


def final(part):
    while part.folded is not None:
        part = part.folded
    return part


def main_text(tree, wrapper):
    """Main text of a page: its blocks in order, joined by one space."""
    folded = page_wrapper(tree)
    roles = match_roles(folded.kids, wrapper.kids, wrapper.main)
    roles[id(folded)] = wrapper.main
    blocks = []

    def collect(part):
        for kid in part.kids:
            if kid.label == "#":
                if roles.get(id(final(kid)), False):
                    blocks.append(kid.text)
            else:
                collect(kid)

    collect(tree)
    return " ".join(blocks)


def all_text(tree):
    return digest(" ".join(p.text for p in flat(tree) if p.label == "#"))


def flat(part):
    yield part
    for kid in part.kids:
        yield from flat(kid)


FIELDS = ["host", "bucket", "skeleton", "wrapper", "texts", "salts"]
PARTIAL = "host string, bucket int, skeleton bigint, wrapper string, texts array<bigint>, salts int"


def batch_of(rows):
    columns = list(zip(*rows))
    types = [pa.string(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], FIELDS)


def least(texts):
    """The least digests of page texts: enough to tell few different texts from many."""
    return sorted(set(texts))[:LEAST_VARIED]


class Partial:
    """Wrapper of several pages with the digests of some of their texts and the salts they use."""

    def __init__(self, root, texts, salts):
        self.root, self.texts, self.salts = root, texts, salts

    def add(self, other):
        merge_into(self.root, other.root)
        self.texts = least(self.texts + other.texts)
        self.salts |= other.salts

    def row(self, host, bucket, shape):
        return host, bucket, shape, json.dumps(self.root.dump(), separators=(",", ":")), self.texts, self.salts


def signed(mask):
    return mask - 2**32 if mask >= 2**31 else mask


def induce(batches):
    """mapInArrow function: (host, salt, html) to partial wrappers, one per structure and host."""

    def take():
        for (host, shape), partial in held.items():
            partial.salts = signed(partial.salts)
            yield partial.row(host, shape % BUCKETS, shape)
        held.clear()

    held = {}
    for batch in batches:
        for host, salt, page in zip(*(batch.column(i) for i in range(3))):
            tree = page_tree(page.as_py() or "")
            made = Partial(page_wrapper(tree), [all_text(tree)], 1 << salt.as_py())
            key = host.as_py(), digest(skeleton(made.root))
            if key in held:
                held[key].add(made)
            else:
                held[key] = made
        if len(held) > HELD_WRAPPERS:
            yield batch_of(list(take()))
    if held:
        yield batch_of(list(take()))


def folding(by_bucket):
    """mapInArrow function over sorted partial wrappers: one per host, or per host and bucket."""

    def run(batches):
        current, held = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                key = (row["host"], row["bucket"]) if by_bucket else (row["host"], 0)
                made = Partial(Part.load(json.loads(row["wrapper"])), row["texts"], row["salts"] & 0xFFFFFFFF)
                if key == current:
                    held.add(made)
                else:
                    if held is not None:
                        out.append(finish(held, current))
                    current, held = key, made
            if out:
                yield batch_of(out)
        if held is not None:
            yield batch_of([finish(held, current)])

    def finish(partial, key):
        partial.salts = signed(partial.salts)
        if not by_bucket:
            decide(partial.root, len(partial.texts) >= LEAST_VARIED)
        return partial.row(*key, 0)

    return run


def host_column(url):
    """Lower-cased (A-Z) host of a url: after the first `://` up to `/`, `?`, `#` or the end; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_wrappers(pages):
    """host, wrapper (JSON), salts (bits of the salts its pages use): one row per host."""
    partial = pages.select("host", "salt", "html").mapInArrow(induce, PARTIAL)
    sorted_partial = partial.repartition("host", "bucket").sortWithinPartitions("host", "bucket", "skeleton")
    buckets = sorted_partial.mapInArrow(folding(True), PARTIAL)
    whole = buckets.repartition("host").sortWithinPartitions("host", "bucket").mapInArrow(folding(False), PARTIAL)
    return staged(whole.select("host", "wrapper", "salts"), "page-wrappers")


def extracting(batches):
    """mapInArrow function over rows sorted by host and salt, in which the wrapper stands before the pages."""
    host, wrapper = None, None
    for batch in batches:
        hosts, wrappers, pages = batch.column(0), batch.column(1), batch.column(batch.num_columns - 1)
        rows, texts = [], []
        for i in range(batch.num_rows):
            given = wrappers[i].as_py()
            if given is not None:
                host, wrapper = hosts[i].as_py(), Part.load(json.loads(given))
                continue
            rows.append(i)
            texts.append(main_text(page_tree(pages[i].as_py() or ""), wrapper))
        if rows:
            kept = batch.take(pa.array(rows))
            text = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([kept.column(2), kept.column(3), text], ["page_id", "url", "text"])


def main_texts(pages):
    """page_id, url, text, n_chars of each page: its main text without markup, menus, headers, footers, side bars,
    notices, adverts, forms, scripts, styles and comments; character references are decoded, white space inside a block
    is one space, blocks are joined in page order by one space.

    One row per row of the table, repeated rows included. Null or empty html, and pages without main text, give the empty
    text. A null url, or one without `://`, belongs to the host of empty name. Tags that are never closed end with their
    parent, a comment or script that is never closed with the page. Pages of any length are read whole;
    blocks nested deeper than 150 count as part of the block at that depth. The result does
    not depend on the order of rows: partial wrappers are merged in the order of their structure. Columns other than page_id, url, html are not read.
    """
    source = pages.select(
        "page_id", "url", F.col("html").cast("string").alias("html"), host_column(F.col("url").cast("string")).alias("host"),
        F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int").alias("salt"),
    )
    wrappers = host_wrappers(source)
    copies = wrappers.select(
        "host", F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), s -> shiftright(salts, s) & 1 = 1)")).alias("salt"), "wrapper"
    )
    none = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in source.schema if f.name in ("page_id", "url", "html")}
    both = copies.select("host", "wrapper", none["page_id"], none["url"], none["html"], "salt").unionByName(
        source.select("host", F.lit(None).cast("string").alias("wrapper"), "page_id", "url", "html", "salt")
    )
    met = both.repartition("host", "salt").sortWithinPartitions("host", "salt", F.col("wrapper").isNull())
    columns = met.select("host", "wrapper", "page_id", "url", "html")
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    found = columns.mapInArrow(extracting, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
