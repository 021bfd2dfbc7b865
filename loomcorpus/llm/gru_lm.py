"""LM scoring: a gated recurrent language model.

Words are ids of a vocabulary counted over the whole corpus, by frequency; a class is a range
of ids, short where words are frequent, and the output softmax is P(class | state)
P(word | class, state). A word that isn't among the WORDS most frequent is the id of its head, its first HEAD
bytes, among the HEADS most frequent of such words; the rest of it is spelled by the corpus's pairs of
bytes. So the recurrent model reads and predicts every word, or how it begins, and every text has a
likelihood. What has a rare head too is the id UNKNOWN, spelled from its first byte on.

Training is one pass over all documents in ROUNDS parts. In each, every task trains a copy of
the model on its own documents by truncated backpropagation (windows of WINDOW words, the
state carried from one to the next, Adam), and the copies are averaged by their words, first
within groups of tasks and then on the driver. So what is gathered grows with the corpus,
and what reaches the driver at once doesn't. Texts are read twice, to count and to encode;
training and scoring read the ids, and nothing but counts and models is shuffled.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, release, segment_sums, word_chunks

#: Production parameters: hidden units, words of each class (END and UNKNOWN are the first), lanes and words of a training window.
HIDDEN, SIZES = 12, (2, *[8] * 8, *[24] * 10, *[64] * 12, *[176] * 16)
#: Bytes of a head, and how many of the ids are heads.
HEAD, HEADS = 3, 1024
WORDS = sum(SIZES) - 2 - HEADS
LANES, WINDOW, ROUNDS, RATE = 512, 16, 4, 0.01
SCORE_LANES, SCORE_WINDOW = 512, 128
#: Words that a task holds at once, in training and in scoring.
HELD = 4_000_000
END, UNKNOWN = 0, 1
#: A context of bytes, or an outcome: the border of a word.
BORDER = 256


def heads_of(words) -> np.ndarray:
    """The first HEAD bytes of each word as a number, zeros where it is shorter."""
    buf = np.concatenate((words.buf, np.zeros(HEAD, np.uint8)))
    size, out = words.end - words.start, np.zeros(len(words.start), np.int64)
    for k in range(HEAD):
        out = out * 256 + np.where(size > k, buf[words.start + k], 0)
    return out


class Vocabulary:
    """Ids of words and heads, all by frequency, and the cost of spelling what they leave.

    hashes: of the words; heads: of other words; either's ids are given by `ids`. pairs: (257, 257) counts
    of bytes by the byte before, BORDER for none.
    """

    def __init__(self, hashes: np.ndarray, heads: np.ndarray, ids: np.ndarray, pairs: np.ndarray):
        n = len(hashes)
        order = np.argsort(hashes)
        self.hashes, self.word_ids = hashes[order], ids[:n][order]
        order = np.argsort(heads)
        self.heads, self.head_ids = heads[order], ids[n:][order]
        self.log_pair = np.log((pairs + 1.0) / (pairs + 1.0).sum(1, keepdims=True))

    def encode(self, words) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, log-likelihood of each text's spelled bytes)."""
        h, head = words.hashes(), heads_of(words)
        ids = np.full(len(h), UNKNOWN, np.uint16)
        by_head = np.zeros(len(h), bool)
        if len(self.heads):
            at = np.minimum(np.searchsorted(self.heads, head), len(self.heads) - 1)
            by_head = self.heads[at] == head
            ids[by_head] = self.head_ids[at[by_head]]
        known = np.zeros(len(h), bool)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
            known = self.hashes[at] == h
            ids[known] = self.word_ids[at[known]]
        buf = words.buf.astype(np.int64)
        before = np.concatenate(([BORDER], buf[:-1]))
        before[words.start] = BORDER
        cost = np.concatenate(([0.0], np.cumsum(self.log_pair[before, buf])))
        size = words.end - words.start
        rest = np.where(by_head, np.minimum(words.start + HEAD, words.end), words.start)
        spelled = cost[words.end] - cost[rest] + np.where(by_head & (size < HEAD), 0.0, self.log_pair[buf[np.maximum(words.end - 1, 0)], BORDER] if len(size) else 0.0)
        return ids, segment_sums(np.where(known, 0.0, spelled), words.first)


def _count(batches):
    """Of one task: (kind, key, head, n) with kind 0 for word hashes, 1 for pairs of bytes."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    pairs = np.zeros(257 * 257, np.int64)

    def merged():
        h, head, n = (np.concatenate(x) for x in zip(*held))
        keys, first, where = np.unique(h, return_index=True, return_inverse=True)
        return keys, head[first], np.bincount(where, n, len(keys)).astype(np.int64)

    for b in batches:
        for _, _, words in word_chunks(b.column(0)):
            h, first, n = np.unique(words.hashes(), return_index=True, return_counts=True)
            held.append((h, heads_of(words)[first], n))
            buf = words.buf.astype(np.int64)
            before = np.concatenate(([BORDER], buf[:-1]))
            before[words.start] = BORDER
            solid = np.zeros(len(buf) + 1, np.int8)
            np.add.at(solid, words.start, 1)
            np.add.at(solid, words.end, -1)
            solid = np.cumsum(solid[:-1]).astype(bool)
            pairs += np.bincount((before * 257 + buf)[solid], minlength=257 * 257)
            pairs += np.bincount(buf[words.end - 1] * 257 + BORDER, minlength=257 * 257) if len(words.end) else 0
            if len(held) >= 64:
                held = [merged()]
    if held:
        keys, head, n = merged()
        some = np.flatnonzero(pairs)
        kind = np.concatenate((np.zeros(len(keys), np.int32), np.ones(len(some), np.int32)))
        yield pa.record_batch([pa.array(kind), pa.array(np.concatenate((keys.view(np.int64), some))), pa.array(np.concatenate((head, some))), pa.array(np.concatenate((n, pairs[some])))], ["kind", "key", "head", "n"])
    release()


def build_vocabulary(docs: DataFrame, words: int = WORDS, heads: int = HEADS) -> Vocabulary:
    """The most frequent words of all documents, and the most frequent heads of the others; ties by hash and head.

    Counts are made in the tasks and summed; the driver gets what is chosen, and at most 257 * 257 pairs of bytes.
    """
    counts = docs.select("text").mapInArrow(_count, "kind int, key bigint, head bigint, n bigint").groupBy("kind", "key").agg(F.max("head").alias("head"), F.sum("n").alias("n"))
    counts = durable(counts)
    pairs = np.zeros(257 * 257)
    for r in counts.where("kind = 1").select("key", "n").collect():
        pairs[r["key"]] = r["n"]
    top = counts.where("kind = 0").orderBy(F.desc("n"), "key").limit(words).select("key", "n").collect()
    # The others are those that come after the last of them in that order.
    others = counts.where("kind = 0")
    others = others.where((F.col("n") < top[-1]["n"]) | (F.col("n") == top[-1]["n"]) & (F.col("key") > top[-1]["key"])) if top else others
    first = others.groupBy("head").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "head").limit(heads).collect()
    n = np.array([r["n"] for r in top] + [r["n"] for r in first], np.int64)
    ids = np.empty(len(n), np.uint16)
    ids[np.argsort(-n, kind="stable")] = np.arange(2, len(n) + 2)
    return Vocabulary(np.array([r["key"] for r in top], np.int64).view(np.uint64), np.array([r["head"] for r in first], np.int64), ids, pairs.reshape(257, 257))


class Model:
    """Parameters and passes; features run down, words across, so that every slice is made of long rows.

    x: (3H, words) input columns; u, b: recurrence; c, cb: classes; w, wb: words, within their class.
    """

    NAMES = ("x", "u", "b", "c", "cb", "w", "wb")
    #: Bounds of weights and offsets, with which no score overflows.
    MOST = {"c": 4.0, "cb": 16.0, "w": 4.0, "wb": 16.0}

    def __init__(self, hidden: int = HIDDEN, sizes: tuple[int, ...] = SIZES, seed: int = 11):
        rng = np.random.default_rng(seed)
        make = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        self.hidden, self.base = hidden, np.concatenate(([0], np.cumsum(sizes)))
        self.class_of, classes, words = np.repeat(np.arange(len(sizes)), sizes), len(sizes), int(sum(sizes))
        self.x = make(3 * hidden, words, scale=0.1)
        self.u = make(3 * hidden, hidden, scale=hidden**-0.5)
        self.b = np.zeros((3 * hidden, 1), np.float32)
        self.c, self.cb = make(classes, hidden, scale=0.1), np.zeros((classes, 1), np.float32)
        self.w, self.wb = make(words, hidden, scale=0.1), np.zeros((words, 1), np.float32)

    def pack(self) -> bytes:
        return b"".join(getattr(self, k).astype("<f4").tobytes() for k in self.NAMES)

    def unpack(self, flat: np.ndarray) -> Model:
        at = 0
        for k in self.NAMES:
            old = getattr(self, k)
            setattr(self, k, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        return self

    def forward(self, inputs: np.ndarray, h: np.ndarray, keep: np.ndarray | None):
        """(before, gates, un, after) of a window: the states before and after each step, each (rows, steps, lanes).

        inputs: (steps, lanes); h: (H, lanes); keep: 0 where a step starts a document, from the zero state.
        """
        (steps, lanes), H = inputs.shape, self.hidden
        g = np.take(self.x, inputs.ravel(), axis=1)
        g += self.b
        g = g.reshape(3 * H, steps, lanes)
        g[: 2 * H] *= np.float32(0.5)
        u = self.u.copy()
        u[: 2 * H] *= np.float32(0.5)  # a sigmoid is a tanh of half its argument
        before, un, after = (np.empty((H, steps, lanes), np.float32) for _ in range(3))
        for t in range(steps):
            if keep is not None:
                h = h * keep[t]
            before[:, t] = h
            a = u @ h
            zr, n = g[: 2 * H, t], g[2 * H :, t]
            zr += a[: 2 * H]
            np.tanh(zr, out=zr)
            zr *= np.float32(0.5)
            zr += np.float32(0.5)
            un[:, t] = a[2 * H :]
            n += zr[H:] * a[2 * H :]
            np.tanh(n, out=n)
            h = h - n
            h *= zr[:H]
            h += n
            after[:, t] = h
        return before, g, un, after

    def log_likelihood(self, states: np.ndarray, targets: np.ndarray, grads: dict | None = None):
        """(log-likelihood of each target under its state, d states); with grads, those of the mean loss go there."""
        k = self.class_of[targets]
        rows = np.arange(len(targets))
        e = self.c @ states
        e += self.cb
        ll = e[k, rows]
        np.exp(e, out=e)
        total = e.sum(0)
        ll -= np.log(total)
        scale, ds = np.float32(1 / max(len(targets), 1)), None
        if grads is not None:
            e *= scale / total
            e[k, rows] -= scale
            grads["c"], grads["cb"] = e @ states.T, e.sum(1, keepdims=True)
            ds = self.c.T @ e
            grads["w"], grads["wb"] = np.zeros_like(self.w), np.zeros_like(self.wb)
        order = np.argsort(targets.astype(np.uint16), kind="stable")
        y = targets[order]
        cut, s = np.searchsorted(y, self.base), np.take(states, order, axis=1)
        inside = np.empty(len(order), np.float32)
        back = np.empty_like(s) if grads is not None else None
        for q in np.flatnonzero(np.diff(cut)):
            i, j = cut[q], cut[q + 1]
            own = slice(self.base[q], self.base[q + 1])
            p = self.w[own] @ s[:, i:j]
            p += self.wb[own]
            at = (y[i:j] - self.base[q], rows[: j - i])
            picked = p[at]
            np.exp(p, out=p)
            total = p.sum(0)
            inside[i:j] = picked - np.log(total)
            if grads is not None:
                p *= scale / total
                p[at] -= scale
                grads["w"][own], grads["wb"][own] = p @ s[:, i:j].T, p.sum(1, keepdims=True)
                back[:, i:j] = self.w[own].T @ p
        ll[order] += inside
        if grads is not None:
            back += np.take(ds, order, axis=1)
            ds[:, order] = back
        return ll, ds

    def gradients(self, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray, keep: np.ndarray):
        """(mean loss, gradients, state after the window), backpropagated within the window only."""
        (steps, lanes), H = inputs.shape, self.hidden
        before, gates, un, after = self.forward(inputs, h, keep)
        g: dict = {}
        ll, ds = self.log_likelihood(after.reshape(H, -1), targets.ravel(), g)
        ds = ds.reshape(H, steps, lanes)
        z, r, n = gates[:H], gates[H : 2 * H], gates[2 * H :]
        into_n = (1 - z) * (1 - n * n)
        into_z = (before - n) * z * (1 - z)
        into_r = un * r * (1 - r)
        dg, da = np.empty_like(gates), np.empty((3 * H, lanes), np.float32)
        dh, ut = np.zeros((H, lanes), np.float32), np.ascontiguousarray(self.u.T)
        for t in range(steps - 1, -1, -1):
            dh += ds[:, t]
            np.multiply(dh, into_z[:, t], out=da[:H])
            dn = dh * into_n[:, t]
            np.multiply(dn, into_r[:, t], out=da[H : 2 * H])
            np.multiply(dn, r[:, t], out=da[2 * H :])
            dg[: 2 * H, t], dg[2 * H :, t] = da[: 2 * H], dn
            dh *= z[:, t]
            dh += ut @ da
            dh *= keep[t]
        flat = dg.reshape(3 * H, -1)
        g["b"] = flat.sum(1, keepdims=True)
        words = inputs.ravel()
        g["x"] = np.stack([np.bincount(words, row, self.x.shape[1]) for row in flat]).astype(np.float32)
        dg[2 * H :] *= r  # now what reaches the recurrence
        g["u"] = flat @ before.reshape(H, -1).T
        return -float(ll.mean()), g, np.ascontiguousarray(after[:, -1])


class Adam:
    def __init__(self, model: Model, rate: float):
        self.model, self.rate, self.step = model, rate, 0
        self.m = {k: np.zeros_like(getattr(model, k)) for k in Model.NAMES}
        self.v = {k: np.zeros_like(getattr(model, k)) for k in Model.NAMES}

    def update(self, grads: dict) -> None:
        self.step += 1
        rate = np.float32(self.rate * math.sqrt(1 - 0.99**self.step) / (1 - 0.9**self.step))
        for k, g in grads.items():
            m, v = self.m[k], self.v[k]
            m += np.float32(0.1) * (g - m)
            v += np.float32(0.01) * (g * g - v)
            p = getattr(self.model, k)
            p -= rate * m / (np.sqrt(v) + np.float32(1e-8))
            if k in Model.MOST:
                np.clip(p, -Model.MOST[k], Model.MOST[k], out=p)


def train(model: Model, stream: np.ndarray, rate: float = RATE, lanes: int = LANES, window: int = WINDOW) -> list[float]:
    """One pass over documents laid end to end, each closed by END. Returns the loss of each window.

    The stream is cut into `lanes` equal lanes that run side by side; a lane that is too
    short is filled up from the start of the stream.
    """
    lanes = max(1, min(lanes, len(stream) // window))
    steps = -(-len(stream) // lanes)
    y = np.resize(stream, lanes * steps).reshape(lanes, steps).T.astype(np.int64)
    x = np.concatenate((np.full((1, lanes), END), y[:-1]))
    keep = (x != END).astype(np.float32)
    h, adam, losses = np.zeros((model.hidden, lanes), np.float32), Adam(model, rate), []
    for a in range(0, steps, window):
        loss, grads, h = model.gradients(x[a : a + window], y[a : a + window], h, keep[a : a + window])
        adam.update(grads)
        losses.append(loss)
    return losses


def score(model: Model, docs: list[np.ndarray], lanes: int = SCORE_LANES, window: int = SCORE_WINDOW) -> np.ndarray:
    """Log-likelihood of each whole document, its END included.

    Documents are packed into lanes, longest first, each into the lane that is shortest
    so far; lanes run side by side, and the state goes on from window to window.
    """
    n = np.array([len(d) + 1 for d in docs], np.int64)
    out = np.zeros(len(docs))
    if not len(docs):
        return out
    lanes = int(np.clip(n.sum() // n.max(), 1, lanes))
    load = np.zeros(lanes, np.int64)
    placed: list[list[int]] = [[] for _ in range(lanes)]
    import heapq

    heap = [(0, k) for k in range(lanes)]
    for i in np.argsort(-n, kind="stable"):
        size, k = heapq.heappop(heap)
        placed[k].append(int(i))
        load[k] = size + n[i]
        heapq.heappush(heap, (int(load[k]), k))
    by = np.argsort(-load, kind="stable")
    load = load[by]
    end = np.array([END], np.uint16)
    rows = [np.concatenate([p for i in placed[k] for p in (docs[i], end)]) for k in by]
    owner = [np.repeat(np.array(placed[k]), n[placed[k]]) for k in by]
    h = np.zeros((model.hidden, lanes), np.float32)
    last = np.full(lanes, END)
    a = 0
    while a < load[0]:
        live = int(np.searchsorted(-load, -a, side="left"))  # lanes longer than a
        z = int(min(a + window, load[live - 1]))  # as far as all of them go
        y = np.stack([rows[k][a:z] for k in range(live)], 1).astype(np.int64)
        x = np.concatenate((last[None, :live], y[:-1]))
        starts = x == END
        states = model.forward(x, h[:, :live], (~starts).astype(np.float32) if starts.any() else None)[-1]
        ll, _ = model.log_likelihood(states.reshape(model.hidden, -1), y.ravel())
        who = np.stack([owner[k][a:z] for k in range(live)], 1).reshape(-1)
        out += np.bincount(who, ll, len(docs))
        h, last, a = np.ascontiguousarray(states[:, -1]), y[-1], z
    return out


def _encode(vocabulary: Vocabulary):
    def run(batches):
        for b in batches:
            for i, n, words in word_chunks(b.column(1)):
                ids, spelled = vocabulary.encode(words)
                packed = [ids[p:q].astype("<u2").tobytes() for p, q in zip(words.first[:-1], words.first[1:])]
                yield pa.record_batch([b.column(0)[i : i + n], pa.array(words.counts.astype(np.int64)), pa.array(spelled), pa.array(packed, pa.binary()), b.column(2)[i : i + n]], ["doc_id", "n_words", "spelled", "ids", "part"])

    return run


def _held(batches, column: int):
    """Lists of record batches of about HELD words."""
    held, size = [], 0
    for b in batches:
        held.append(b)
        size += b.column(column).nbytes // 2
        if size >= HELD:
            yield held
            held, size = [], 0
    if held:
        yield held


def _train(model: Model):
    def run(batches):
        end = np.array([END], np.uint16).tobytes()
        for held in _held(batches, 0):
            stream = np.frombuffer(b"".join(p for b in held for ids in b.column(0).to_pylist() for p in (ids, end)), "<u2")
            losses = train(model, stream)
            yield pa.record_batch([pa.array([float(len(stream))]), pa.array([float(np.mean(losses[-20:]))]), pa.array([model.pack()], pa.binary())], ["words", "loss", "model"])

    return run


def _average(batches):
    words, loss, total = 0.0, 0.0, None
    for b in batches:
        for n, x, packed in zip(*[b.column(k).to_pylist() for k in range(3)]):
            v = np.frombuffer(packed, "<f4").astype(np.float64) * n
            words, loss, total = words + n, loss + n * x, v if total is None else total + v
    if words:
        yield pa.record_batch([pa.array([words]), pa.array([loss / words]), pa.array([(total / words).astype("<f4").tobytes()], pa.binary())], ["words", "loss", "model"])


def fit(encoded: DataFrame, rounds: int = ROUNDS) -> Model:
    """Rounds of local training and averaging; each document trains once."""
    model = Model()
    groups = max(1, math.isqrt(int(encoded.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    schema = "words double, loss double, model binary"
    for r in range(rounds):
        local = encoded.where(F.col("part") == r).select("ids").mapInArrow(_train(model), schema)
        grouped = local.repartition(groups).mapInArrow(_average, schema)
        means = list(_average(grouped.toArrow().to_batches()))
        if means:
            model = Model().unpack(np.frombuffer(means[0].column(2)[0].as_py(), "<f4"))
    return model


def _score(model: Model):
    def run(batches):
        for held in _held(batches, 3):
            ids = [np.frombuffer(x, "<u2") for b in held for x in b.column(3).to_pylist()]
            ll = score(model, ids)
            at = 0
            for b in held:
                total = ll[at : at + b.num_rows] + b.column(2).to_numpy()
                at += b.num_rows
                each = np.exp(np.minimum(-total / (b.column(1).to_numpy() + 1), 700))
                yield pa.record_batch([b.column(0), b.column(1), pa.array(np.round(total, 3)), pa.array(np.round(each, 3))], ["doc_id", "n_words", "log_likelihood", "perplexity"])

    return run


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, log_likelihood, perplexity) of every row under a model trained on all rows.

    Words stand between ASCII white space. log_likelihood (natural) is that of the whole
    text and its end; perplexity is per word, the end counted as one. Null and empty texts
    have 0 words and the likelihood of an end alone. Repeated rows repeat, and count as
    often in training; null ids stay null. An empty table gives no rows; extra columns are ignored.
    Each task trains on the documents it has, so scores depend a little on how the table is partitioned; equal
    texts of one run have equal scores.
    """
    vocabulary = build_vocabulary(docs)
    part = F.pmod(F.xxhash64("doc_id", F.col("text")), F.lit(ROUNDS)).cast("int")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", part.alias("part"))
    encoded = durable(rows.mapInArrow(_encode(vocabulary), "doc_id bigint, n_words bigint, spelled double, ids binary, part int"))
    return encoded.mapInArrow(_score(fit(encoded)), "doc_id bigint, n_words bigint, log_likelihood double, perplexity double")
