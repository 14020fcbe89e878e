"""Language model scoring with a gated recurrent network and smoothed word counts.

The network is small and written in numpy: gated units, a softmax in two steps (class of
the word, then the word in its class), trained by backpropagation through windows of fixed
length with the state carried on. All tasks train it on their own texts and their weights are
averaged, round by round. It knows the most frequent words; all others are one
symbol to it, and share that symbol's probability by their smoothed counts.
"""

import copy
import io
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from leakwatch.llm import text as T

END = b"\n"  # cannot be a word
SMOOTH = 0.1
FREQUENT = 300_000
WORDS = 1024
CLASSES = 32
UNITS = 24
WINDOW = 32
STREAMS = 64
EPOCHS = 2  # rounds, each over all texts
BLOCK_TOKENS = 1 << 20
RATE = 0.01
BLOCK = 1024
PIECE_BYTES = 8 << 20


def tokens(text):
    """Lower-cased words and one end."""
    return [*T.lower_words(text), END]


def pieces(column, size=PIECE_BYTES):
    """An Arrow column of texts in stretches of about `size` bytes; a longer text is one of its own."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        stop = max(int(np.searchsorted(ends, before + size, "right")), at + 1)
        yield column.slice(at, stop - at)
        at = stop


def flat_words(column):
    """The lower-cased words (bytes) of all texts of an Arrow column end to end, and how many each text has.

    Arrow's ASCII white space is exactly the six characters that no word holds.
    """
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(column, "")))
    lists = pc.ascii_split_whitespace(trimmed)
    words, size = lists.flatten().cast(pa.binary()), pc.list_value_length(lists).to_numpy().astype(np.int64)
    blank = pc.binary_length(trimmed).to_numpy() == 0
    if blank.any():  # each comes as one empty word
        words, size = words.filter(pc.not_equal(words, b"")), np.where(blank, 0, size)
    return words, size


def places(words, value_set):
    """Place of each word in `value_set`, its length for none."""
    return pc.fill_null(pc.index_in(words, value_set=value_set), len(value_set)).to_numpy()


def with_ends(values, size, end):
    """Values of words end to end, with `end` after each text, and where each text begins and stops."""
    stop = np.cumsum(size + 1)
    begin = stop - size - 1
    out = np.empty(int(stop[-1]) if len(stop) else 0, values.dtype)
    inside = np.ones(len(out), bool)
    inside[stop - 1] = False
    out[inside] = values
    out[stop - 1] = end
    return out, begin, stop


def token_counts(docs):
    """word (bytes), c: of all tokens of all rows. Tasks send the sums of a stretch of texts at once."""

    def run(batches):
        for batch in batches:
            for column in pieces(batch.column(0)):
                found = pc.value_counts(flat_words(column)[0])
                word = pa.concat_arrays([found.field("values"), pa.array([END], pa.binary())])
                count = pa.concat_arrays([found.field("counts"), pa.array([len(column)], pa.int64())])
                yield pa.RecordBatch.from_arrays([word, count], ["word", "c"])

    return docs.select("text").mapInArrow(run, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def classes(weights, count=CLASSES):
    """Class of each word for words sorted by falling weight: equal shares of root weight."""
    share = np.cumsum(np.sqrt(weights))
    share /= share[-1]
    found = np.minimum((share * count - 1e-9).astype(int), count - 1)
    return np.unique(found, return_inverse=True)[1]


def _top(logits, begin=None, width=None):
    """What to take off logits before exp: the greatest of all where they lie close enough, else that of each row.

    Rows are those of a matrix, or stretches of a flat array.
    """
    if not logits.size:
        return 0
    high = logits.max()
    if high - logits.min() < 60:
        return high
    if begin is None:
        return logits.max(axis=1, keepdims=True)
    return np.repeat(np.maximum.reduceat(logits, begin), width)


def _state_step(h, e, against, candidate, gates, rh, c, after):
    """One step of the units into `gates`, `rh`, `c` and the next state `after`; a column per stream.

    e: inputs of the words; those of the gates, like the weights `against`, come with their sign turned.
    """
    u = len(h)
    np.matmul(against, h, out=gates)
    gates += e[: 2 * u]
    np.exp(gates, out=gates)
    gates += 1
    np.reciprocal(gates, out=gates)
    np.multiply(gates[u:], h, out=rh)
    np.matmul(candidate, rh, out=c)
    c += e[2 * u :]
    np.tanh(c, out=c)
    np.subtract(c, h, out=rh if after is h else after)
    if after is h:
        rh *= gates[:u]
        h += rh
    else:
        after *= gates[:u]
        after += h


def _turned(x):
    """The last two axes swapped, as an array of its own."""
    return np.ascontiguousarray(x.swapaxes(-1, -2))


def _in_one(p):
    """A copy of all arrays end to end, and the views of it that they are."""
    flat, views, at = np.concatenate([v.ravel() for v in p.values()]), {}, 0
    for k, v in p.items():
        views[k] = flat[at : at + v.size].reshape(v.shape)
        at += v.size
    return flat, views


def _adam(flat, gradient, first, second, n, speed, turn, block=1 << 14):
    """Move the weights by the moments of their gradient, a stretch that stays in cache at a time."""
    scale = math.sqrt(1 - 0.99**turn)
    speed *= scale / (1 - 0.9**turn)
    made = np.empty(min(block, len(flat)), flat.dtype)
    for at in range(0, len(flat), block):
        g, one, two = gradient[at : at + block], first[at : at + block], second[at : at + block]
        now = made[: len(g)]
        g *= 1 / max(n, 1)
        np.subtract(g, one, out=now)
        now *= 0.1
        one += now
        np.multiply(g, g, out=now)
        now -= two
        now *= 0.01
        two += now
        np.sqrt(two, out=now)
        now += 1e-8 * scale
        np.divide(one, now, out=now)
        now *= speed
        flat[at : at + block] -= now


class Network:
    """Gated recurrent network over word numbers 0..words-1, sorted by class."""

    def __init__(self, weights, units=UNITS, count=CLASSES, seed=7):
        weights = np.asarray(weights, float) + 1.0
        self.cls = classes(weights, count)
        self.start = np.searchsorted(self.cls, np.arange(self.cls.max() + 2))
        self.units = units
        rng = np.random.default_rng(seed)
        words, groups = len(weights), len(self.start) - 1

        def draw(*shape):
            return (rng.normal(size=shape) * 0.1).astype(np.float32)

        mass = np.add.reduceat(weights, self.start[:-1])
        self.p = {
            "e": draw(words, 3 * units),  # input of a word to both gates and the candidate
            "g": draw(units, 2 * units),
            "c": draw(units, units),
            "wc": draw(units, groups),
            "bc": np.log(mass / mass.sum()).astype(np.float32),
            "wo": draw(units, words),
            "bo": np.log(weights / mass[self.cls]).astype(np.float32),
        }

    def _outputs(self, h, targets, p1c, p1o):
        """Both softmax steps for the states before the targets, with rows in order of the class of their target.

        p1c, p1o: weights of the classes and words, with their bias as the last row. Returns the order, the log
        probabilities, and what the gradient needs.
        """
        cls = self.cls[targets].astype(np.int16)  # 16 bits are sorted by radix
        order = np.argsort(cls, kind="stable")
        cls, rows = cls[order], np.arange(len(order))
        states = np.empty((len(h), self.units + 1), h.dtype)
        states[:, :-1], states[:, -1] = h[order], 1
        q = states @ p1c
        q -= _top(q)
        found = q[rows, cls]
        np.exp(q, out=q)
        sums = q @ np.ones(q.shape[1], q.dtype)
        # The words of each row's class, in one flat array.
        width = np.diff(self.start)[cls]
        begin = np.cumsum(width) - width
        flat = np.empty(int(width.sum()), h.dtype)
        spans, start, at = [], self.start.tolist(), 0
        cuts = np.searchsorted(cls, np.arange(len(start))).tolist()
        for s, e, a, b in zip(cuts, cuts[1:], start, start[1:]):
            if e > s:
                part = flat[at : at + (e - s) * (b - a)].reshape(e - s, b - a)
                at += part.size
                spans.append((slice(s, e), slice(a, b), part))
                np.matmul(states[s:e], p1o[:, a:b], out=part)
        flat -= _top(flat, begin, width)
        place = begin + (targets[order] - self.start[cls])
        found += flat[place]
        np.exp(flat, out=flat)
        parts = np.add.reduceat(flat, begin) if len(begin) else np.zeros(0, h.dtype)
        found -= np.log(sums)
        found -= np.log(parts)
        return order, found, (states, rows, cls, q, sums, flat, place, parts, width, spans)

    def _with_bias(self):
        p = self.p
        return np.concatenate([p["wc"], p["bc"][None]]), np.concatenate([p["wo"], p["bo"][None]])

    def log_probs(self, h, targets, weights=None):
        """Natural log probability of each target word in the state before it."""
        order, found, _ = self._outputs(h, targets, *(weights or self._with_bias()))
        out = np.empty_like(found)
        out[order] = found
        return out

    def _loss_gradient(self, h, targets, d):
        """Put output gradients into `d`; returns that of the states."""
        p1c, p1o = self._with_bias()
        order, _, made = self._outputs(h, targets, p1c, p1o)
        states, rows, cls, q, sums, flat, place, parts, width, spans = made
        q *= (1 / sums)[:, None]
        q[rows, cls] -= 1
        made = states.T @ q
        d["wc"][...], d["bc"][...] = made[:-1], made[-1]
        flat *= np.repeat(1 / parts, width)
        flat[place] -= 1
        dh, made, back = np.empty((len(h), self.units), h.dtype), np.zeros_like(p1o), p1o[:-1].T
        for these, words, part in spans:
            np.matmul(states[these].T, part, out=made[:, words])
            np.matmul(part, back[words], out=dh[these])
        d["wo"][...], d["bo"][...] = made[:-1], made[-1]
        dh += q @ p1c[:-1].T
        out = np.empty_like(dh)
        out[order] = dh
        return out

    def window_gradient(self, ids, h0, fresh, d=None):
        """Gradients over one window of streams; the state comes in, its gradient does not go back.

        ids: (steps, streams), -1 for none. fresh: where a text begins, and the state is 0.
        d: arrays for the gradients. Returns (gradients, last state, tokens).
        """
        p, u, (steps, n) = self.p, self.units, ids.shape
        d = {k: np.empty_like(v) for k, v in p.items()} if d is None else d
        live = ids >= 0
        ended, begins = (~live.all(axis=1)).tolist(), fresh.any(axis=1).tolist()
        e = _turned(p["e"][np.maximum(ids, 0)])
        np.negative(e[:, : 2 * u], out=e[:, : 2 * u])
        against, candidate = -p["g"].T, _turned(p["c"])
        # Steps, then units, then streams: what a step works on lies together.
        states = np.empty((steps + 1, u, n), h0.dtype)
        gates = np.empty((steps, 2 * u, n), h0.dtype)
        rh, c = np.empty((steps, u, n), h0.dtype), np.empty((steps, u, n), h0.dtype)
        states[0] = h0.T
        for t in range(steps):
            h, after = states[t], states[t + 1]
            if begins[t]:
                h[:, fresh[t]] = 0
            _state_step(h, e[t], against, candidate, gates[t], rh[t], c[t], after)
            if ended[t]:
                after[:, ~live[t]] = h[:, ~live[t]]
        before, places = states[:-1], np.flatnonzero(live)
        rows = _turned(before).reshape(-1, u)
        dstates = np.zeros_like(rows)
        dstates[places] = self._loss_gradient(rows[places], ids.ravel()[places], d)
        dstates = _turned(dstates.reshape(steps, n, u))
        z, r = gates[:, :u], gates[:, u:]
        stay = 1 - z
        to_z = c - before
        to_z *= z
        to_z *= stay
        to_c = c * c
        np.subtract(1, to_c, out=to_c)
        to_c *= z
        to_r = 1 - r
        to_r *= rh
        if any(ended):
            for x, value in (to_c, 0), (to_z, 0), (stay, 1):
                x.swapaxes(1, 2)[~live] = value
        # Gradients of a word's input: gates, then candidate.
        inputs = np.empty((steps, 3 * u, n), h0.dtype)
        dh, drh, dg = np.zeros((u, n), h0.dtype), np.empty((u, n), h0.dtype), np.empty((u, n), h0.dtype)
        for t in range(steps - 1, -1, -1):
            made = inputs[t]
            np.multiply(dh, to_c[t], out=made[2 * u :])
            np.multiply(dh, to_z[t], out=made[:u])
            np.matmul(p["c"], made[2 * u :], out=drh)
            np.multiply(drh, to_r[t], out=made[u : 2 * u])
            np.matmul(p["g"], made[: 2 * u], out=dg)
            dh *= stay[t]
            drh *= r[t]
            dh += drh
            dh += dg
            dh += dstates[t]
            if begins[t]:
                dh[:, fresh[t]] = 0
        flat = _turned(inputs).reshape(-1, 3 * u)
        np.matmul(rows.T, flat[:, : 2 * u], out=d["g"])
        np.matmul(_turned(rh).reshape(-1, u).T, flat[:, 2 * u :], out=d["c"])
        words = ids.ravel().astype(np.int16 if len(p["e"]) < 1 << 15 else np.int64)
        order = np.argsort(words, kind="stable")[words.size - int(live.sum()) :]
        words = words[order]
        at = np.flatnonzero(np.diff(words, prepend=-1))
        d["e"][...] = 0
        d["e"][words[at]] = np.add.reduceat(flat[order], at, axis=0)
        return d, states[-1].T, len(order)

    def train(self, texts, epochs=EPOCHS, streams=STREAMS, window=WINDOW, rate=RATE, span=(0.0, 1.0), moments=None):
        """Fit to texts (arrays of word numbers) laid end to end in parallel streams.

        span: the part of the whole training that this call is; the rate falls along it.
        moments: those of the gradients from the call before, changed in place.
        """
        if not texts:
            return self
        lanes = [[] for _ in range(min(streams, len(texts)))]
        size = [0] * len(lanes)
        for t in sorted(texts, key=len, reverse=True):
            k = size.index(min(size))
            lanes[k].append(t)
            size[k] += len(t)
        steps = max(size)
        ids = np.full((steps, len(lanes)), -1, np.int64)
        fresh = np.zeros((steps, len(lanes)), bool)
        for k, lane in enumerate(lanes):
            at = 0
            for t in lane:
                ids[at : at + len(t), k] = t
                fresh[at, k] = True
                at += len(t)
        flat, self.p = _in_one(self.p)
        gradient, d = _in_one(self.p)
        moments = {} if moments is None else moments
        if not moments:
            moments |= {"turn": 0, "first": np.zeros_like(flat), "second": np.zeros_like(flat)}
        turn, turns = 0, epochs * math.ceil(steps / window)
        for _ in range(epochs):
            h = np.zeros((len(lanes), self.units), np.float32)
            for at in range(0, steps, window):
                on = np.flatnonzero(ids[at] >= 0)  # streams that have not ended
                _, h[on], n = self.window_gradient(ids[at : at + window, on], h[on], fresh[at : at + window, on], d)
                turn += 1
                moments["turn"] += 1
                speed = rate * (1 - 0.9 * (span[0] + (span[1] - span[0]) * turn / turns))
                _adam(flat, gradient, moments["first"], moments["second"], n, speed, moments["turn"])
        return self

    def score(self, texts, block=BLOCK, window=WINDOW):
        """Natural log probability of each text, whole, with the state carried over windows."""
        p, u = self.p, self.units
        against, candidate, weights = -p["g"].T, _turned(p["c"]), self._with_bias()
        total = np.zeros(len(texts))
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        for at in range(0, len(order), block):
            rows = order[at : at + block]
            size = np.array([len(texts[i]) for i in rows])
            flat = np.concatenate([texts[i] for i in rows])
            begin = np.cumsum(size) - size
            h = np.zeros((u, len(rows)), against.dtype)
            gates, rh, c = np.empty((2 * u, len(rows)), h.dtype), np.empty_like(h), np.empty_like(h)
            for t0 in range(0, int(size[0]), window):
                # Texts longer than t come first.
                owners = np.searchsorted(-size, -np.arange(t0, min(t0 + window, int(size[0]))), "left")
                ends = np.cumsum(owners)
                owner = np.arange(ends[-1]) - np.repeat(ends - owners, owners)
                words = flat[begin[owner] + np.repeat(np.arange(t0, t0 + len(owners)), owners)]
                states = np.empty((len(words), u), h.dtype)
                for n, end in zip(owners.tolist(), ends.tolist()):
                    if n != h.shape[1]:
                        h = h[:, :n].copy()
                        gates, rh, c = np.empty((2 * u, n), h.dtype), np.empty((u, n), h.dtype), np.empty((u, n), h.dtype)
                    states[end - n : end] = h.T
                    e = _turned(p["e"][words[end - n : end]])
                    np.negative(e[: 2 * u], out=e[: 2 * u])
                    _state_step(h, e, against, candidate, gates, rh, c, h)
                found = self.log_probs(states, words, weights)
                total[rows[: owners[0]]] += np.bincount(owner, found, minlength=owners[0])
        return total

    def copy(self):
        """A network of its own with the same weights."""
        other = copy.copy(self)
        other.p = {k: v.copy() for k, v in self.p.items()}
        return other

    def to_bytes(self, weight=1.0):
        """The weights of the network times `weight`, as 64-bit numbers."""
        out = io.BytesIO()
        np.savez(out, **{k: v.astype(float) * weight for k, v in self.p.items()})
        return out.getvalue()

    def load(self, sums, weight=1.0):
        """Take sums of weighted networks, divided by the sum of their weights."""
        self.p = {k: (v / weight).astype(np.float32) for k, v in sums.items()}
        return self


def _keep_memory():
    """Let the C library keep the memory of arrays that come and go; it learns from the size of one that is freed."""
    np.empty(31 << 20, np.uint8)


def _plus(sums, data):
    """Sums of weights and the network of to_bytes."""
    with np.load(io.BytesIO(data)) as kept:
        return {k: sums[k] + kept[k] if sums else kept[k] for k in kept.files}


class Model:
    """Network, its words, and the smoothed counts of all frequent words."""

    def __init__(self, frequent, total, distinct, least=1, words=WORDS):
        """frequent: [(word, count)] by falling count, all that reach `least`; total and distinct: of all words."""
        self.total, self.distinct, self.least = total, distinct, least
        self.scale = total + SMOOTH * (distinct + 1)
        self.words = frequent[: words - 1]
        # Number 0.. for known words; the last stands for all others.
        self.other = len(self.words)
        known = sum(c + SMOOTH for _, c in self.words) / self.scale
        self.rest = math.log10(max(1 - known, SMOOTH / self.scale))
        rest = max(total - sum(c for _, c in self.words), 1)
        place = sorted(range(self.other + 1), key=lambda i: -(self.words[i][1] if i < self.other else rest))
        number = {i: k for k, i in enumerate(place)}
        self.other_number = number[self.other]
        weights = [self.words[i][1] if i < self.other else rest for i in place]
        self.network = Network(weights)
        # The words that the network knows, and all frequent ones; `number_of` and `base_of` (log10 of the base
        # probability) of each, last: of none.
        self.known = pa.array([w for w, _ in self.words], pa.binary())
        self.frequent = pa.array([w for w, _ in frequent], pa.binary())
        self.number_of = np.full(len(frequent) + 1, self.other_number, np.int32)
        self.number_of[: self.other] = [number[i] for i in range(self.other)]
        self.known_number = np.append(self.number_of[: self.other], np.int32(self.other_number))
        self.base_of = np.array([*[self.log_base(c) for _, c in frequent], 0.0])

    def learner(self):
        """Only what training needs."""
        other = copy.copy(self)
        other.frequent = other.number_of = other.base_of = None
        return other

    def log_base(self, count):
        return math.log10((count + SMOOTH) / self.scale)

    def numbers(self, column):
        """Of each text of an Arrow column, the numbers of its tokens in the network."""
        words, size = flat_words(column)
        end = self.known_number[places(pa.array([END], pa.binary()), self.known)[0]]
        found, begin, stop = with_ends(self.known_number[places(words, self.known)], size, end)
        return [found[a:b] for a, b in zip(begin.tolist(), stop.tolist())]


NET = "part int, tokens bigint, net binary"


def _net(part, size, data):
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([size], pa.int64()), pa.array([data], pa.binary())], ["part", "tokens", "net"]
    )


def train_round(docs, model, number, rounds, block_tokens=BLOCK_TOKENS):
    """part, tokens, net: of each task that has texts, the network trained further on all of them.

    Whole texts are trained on in blocks of about `block_tokens` tokens, so memory is a
    block; a longer text is a block of its own. The network comes times its tokens.
    """
    held = docs.sparkSession.sparkContext.broadcast(model.learner())
    span = (number / rounds, (number + 1) / rounds)

    def run(batches):
        from pyspark import TaskContext

        _keep_memory()
        own, network, moments = held.value, None, {}
        texts, size, total = [], 0, 0

        def learn():
            network.train(texts, 1, span=span, moments=moments)

        for batch in batches:
            if network is None and batch.num_rows:
                network = own.network.copy()
            for column in pieces(batch.column(0)):
                for text in own.numbers(column):
                    texts.append(text)
                    size += len(text)
                    if size >= block_tokens:
                        learn()
                        texts, size, total = [], 0, total + size
        if network is not None:
            learn()
            yield _net(TaskContext.get().partitionId(), total + size, network.to_bytes(total + size))

    return docs.select("text").mapInArrow(run, NET)


def average(nets):
    """(sums of networks, tokens) of all rows of `train_round`, in a fixed order.

    About sqrt(tasks) tasks add up as many networks each, and the driver their sums one by one.
    """
    groups = max(1, math.isqrt(nets.count()))

    def run(batches):
        group, size, part = {}, 0, None
        for batch in batches:
            for p, n, net in zip(*batch.columns):
                part = p.as_py() if part is None else part
                size += n.as_py()
                group = _plus(group, net.as_py())
        if group:
            out = io.BytesIO()
            np.savez(out, **group)
            yield _net(part, size, out.getvalue())

    dealt = nets.withColumn("_group", F.col("part") % groups).repartition(groups, "_group").sortWithinPartitions("part")
    sums, total = {}, 0
    for row in T.staged(dealt.drop("_group").mapInArrow(run, NET), "lm-sums").orderBy("part").toLocalIterator():
        sums = _plus(sums, bytes(row.net))
        total += row.tokens
    return sums, total


def _least_held(counts, total):
    """The least count that at most FREQUENT words reach.

    No more than that have one part in FREQUENT of all tokens. Below it there are at most
    total / FREQUENT different counts, which are taken from the most frequent down.
    """
    few = F.col("c") * FREQUENT < total
    sizes = counts.groupBy(F.when(few, F.col("c")).alias("c")).agg(F.count(F.lit(1)).alias("n"))
    sizes = {r.c: r.n for r in sizes.collect()}
    held, least = sizes.pop(None, 0), -(-total // FREQUENT)
    for c in sorted(sizes, reverse=True):
        held += sizes[c]
        if held > FREQUENT:
            break
        least = c
    return least


def fit(docs, counts, epochs=EPOCHS):
    """Model from all counts, with the network trained on all texts, `epochs` times each.

    A round is one pass: every task goes on from the same network with the texts it reads, and the
    average by tokens of what they reach is where the next round begins.

    The model holds the FREQUENT most frequent words, less those that share a count over that
    number; the others stay in the table `counts`.
    """
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    least = _least_held(counts, total)
    rows = counts.select("word", "c").where(F.col("c") >= least).toArrow()
    frequent = sorted(zip(rows["word"].to_pylist(), rows["c"].to_pylist()), key=lambda x: (-x[1], x[0]))
    model = Model(frequent, total, distinct, least)
    for number in range(epochs):
        sums, trained = average(T.staged(train_round(docs, model, number, epochs), "lm-nets"))
        if trained:
            model.network.load(sums, trained)
    return model


PARTS = (
    "_n bigint, _known bigint, _base double, _other double, _net double, "
    "_rare array<struct<word:binary,n:int>>"
)


def _rare(words, row, rows):
    """Of the words of each of `rows` rows (`row`: that of each word) the distinct ones with their counts, as a list array."""
    named = words.dictionary_encode()
    kinds = max(len(named.dictionary), 1)
    key, n = np.unique(row * kinds + named.indices.to_numpy(), return_counts=True)
    pairs = pa.StructArray.from_arrays(
        [named.dictionary.take(pa.array(key % kinds)), pa.array(n, pa.int32())], ["word", "n"]
    )
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(key, np.arange(rows + 1) * kinds), pa.int32()), pairs)


def _parts(held):
    """Per text: tokens, known frequent ones, their base score, that of those outside the
    network, the network's score, and the words that are not frequent."""

    def setup():
        _keep_memory()
        model = held.value
        none = len(model.frequent)
        end = places(pa.array([END], pa.binary()), model.frequent)[0]

        def part(column):
            words, size = flat_words(column)
            found = places(words, model.frequent)
            place, begin, stop = with_ends(found, size, end)
            number, base = model.number_of[place], model.base_of[place]
            other = number == model.other_number
            unseen = np.flatnonzero(found == none)
            row = np.repeat(np.arange(len(size)), size)[unseen]
            words = words.take(pa.array(unseen))
            if end == none:
                words = pa.concat_arrays([words, pa.array([END] * len(size), pa.binary())])
                row = np.concatenate([row, np.arange(len(size))])
            known = size + 1 - np.bincount(row, minlength=len(size))
            sums = [np.add.reduceat(x, begin) for x in (base, np.where(other, base, 0.0), other.astype(np.int64))]
            texts = [number[a:b] for a, b in zip(begin.tolist(), stop.tolist())]
            return texts, (size + 1, known, *sums), _rare(words, row, len(size))

        def make(texts):
            numbers, sums, rare = [], [], []
            for column in pieces(texts.column):
                found, made, words = part(column)
                numbers += found
                sums.append(made)
                rare.append(words)
            if not numbers:
                return [[] for _ in range(6)]
            n, known, base, other, outside = map(np.concatenate, zip(*sums))
            net = model.network.score(numbers) / math.log(10) - model.rest * outside
            return n, known, base, other, net, pa.concat_arrays(rare)

        return make

    return setup


def score(docs, model, counts, keep=("doc_id",)):
    """Columns `keep`, n_tokens, n_known, train_tokens, base_score, score (log10), a row per input row.

    Words that are not frequent go as (row, word, n) to the count table and back as one sum
    per row; their number, not the texts, is what is shuffled.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    numbered = docs.select(*keep, "text").withColumn("_row", F.monotonically_increasing_id())
    rows = T.staged(T.map_texts(numbered, [*keep, "_row"], PARTS, _parts(held)), "lm-parts")
    rare = rows.select("_row", F.explode("_rare").alias("r")).select("_row", "r.word", "r.n")
    known = T.staged(counts.where(F.col("c") < model.least), "lm-rare")
    count = F.coalesce("c", F.lit(0))
    looked = rare.join(known, "word", "left").groupBy("_row").agg(
        F.sum(F.when(count > 0, F.col("n")).otherwise(0)).alias("_rare_known"),
        F.sum(F.col("n") * F.log10((count + SMOOTH) / F.lit(model.scale))).alias("_rare_base"),
    )
    rare_base = F.coalesce("_rare_base", F.lit(0.0))
    return rows.drop("_rare").join(looked, "_row", "left").select(
        *keep,
        F.col("_n").alias("n_tokens"),
        (F.col("_known") + F.coalesce("_rare_known", F.lit(0))).alias("n_known"),
        F.lit(int(model.total)).cast("long").alias("train_tokens"),
        (F.col("_base") + rare_base).alias("base_score"),
        (F.col("_net") + F.col("_other") + rare_base).alias("score"),
    )


def language_scores(docs, modulus=10, part=0):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    Counts are taken over all rows outside the held-out part, rows with a null id left out.
    Null and empty texts are one end token. Repeated rows count and score each. An empty
    table gives an empty result; without rows to learn from, every word has the smoothed
    probability of an unseen one. Scores are log10 probabilities of whole texts.

    Scale: counts are summed in tasks before their shuffle and grow with the vocabulary;
    the network and the frequent words have a fixed bound. Training reads all rows in
    all tasks, once a round; a task sends one network.
    """
    learn = docs.where(T.learnable(F.col("doc_id"), modulus, part))
    counts = T.staged(token_counts(learn), "lm-counts")
    model = fit(learn, counts)
    out = score(docs, model, counts)
    return out.select("doc_id", T.held_out(F.col("doc_id"), modulus, part).alias("held_out"), *out.columns[1:])
