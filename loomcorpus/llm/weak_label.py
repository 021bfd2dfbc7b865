"""Quality classifier: weak-label model.

Overlapping heuristic labellers vote good, junk or toxic on each document, or don't vote. How each
votes on each of the three classes is estimated by expectation maximisation (Dawid and Skene's model) from
the counts of vote patterns over the whole corpus, a table as small as the patterns are
few. Several labellers look for each class, and all share it, so that each is measured by the others; what is
assumed beforehand weighs as much as a few documents, whatever the corpus. The posterior of its pattern
labels each document; posteriors of a bounded sample train a linear scorer on hashed word features, which sees
what no labeller does.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FEATURE_BITS, Words, durable, fit_softmax, hashed_features, key_columns, labelled_sample, segment_sums, softmax_scores, word_chunks

CLASSES = ("good", "junk", "toxic")
NONE, GOOD, JUNK, TOXIC = 0, 1, 2, 3
#: Bounds of the labelled rows that marker heads are mined from, and of the rows that train the scorer.
MARKER_ROWS, TRAIN_ROWS = 20_000, 12_000
MARKER_LEVEL, MARKER_PURITY = 0.05, 0.97
INSULTS = "idiot moron stupid scum loser trash pathetic worthless disgusting bastard imbecile idiota imbécil basura idiote crétin ordure connard trottel abschaum dummkopf arschloch".split()
LABELLERS = ("symbols", "signs", "capitals", "variety", "repetition", "shouting", "sentences", "length", "insults", "marker", "markers")
#: Documents that what is assumed of each labeller and class counts as.
PRIOR = 4.0
#: Words of a window that variety is counted in: the share of distinct words falls with length in any text.
VARIETY_WORDS = 1000


def _head(word: str) -> int:
    return int.from_bytes(word.lower().encode()[:4].ljust(4, b"\0"), "big")


INSULT_HEADS = np.array(sorted({int.from_bytes(w.encode()[:6].ljust(6, b"\0"), "big") for w in INSULTS}), np.uint64)


def _heads(batches):
    """(head, n, hit): of some (text, toxic) rows, how many texts and how many toxic ones have each word head."""
    for b in batches:
        toxic = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for i, n, words in word_chunks(b.column(0)):
            head, _ = words.affixes()
            row = np.repeat(np.arange(n, dtype=np.uint64), words.counts)
            pairs = np.unique((row << np.uint64(32)) | head)
            heads, where = np.unique(pairs & np.uint64(2**32 - 1), return_inverse=True)
            hit = np.bincount(where, toxic[i : i + n][(pairs >> np.uint64(32)).astype(np.int64)], len(heads))
            yield pa.record_batch([pa.array(heads.astype(np.int64)), pa.array(np.bincount(where, minlength=len(heads))), pa.array(hit.astype(np.int64))], ["head", "n", "hit"])


def mine_heads(rows: DataFrame) -> np.ndarray:
    """Four-byte word heads that occur with toxic texts beyond chance, and hardly elsewhere. rows: text, toxic.

    Counted where the texts are; the driver gets the heads that qualify, which the sample bounds.
    """
    base = rows.agg(F.avg("toxic")).first()[0] or 0
    if not 0 < base < 1:
        return np.zeros(0, np.uint64)
    counts = durable(rows.select("text", "toxic").mapInArrow(_heads, "head bigint, n bigint, hit bigint").groupBy("head").agg(F.sum("n").alias("n"), F.sum("hit").alias("hit")))
    need = math.log(max(counts.count(), 1) / MARKER_LEVEL) / math.log(1 / base)
    good = counts.where((F.col("hit") >= need) & (F.col("hit") >= MARKER_PURITY * F.col("n")) & (F.col("head") % 256 != 0))
    return np.sort(np.array([r["head"] for r in good.collect()], np.uint64))


def variety(words: Words, head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Distinct (head, tail) share of each text: the mean over consecutive windows of VARIETY_WORDS, by their words."""
    windows = -(-words.counts // VARIETY_WORDS)
    first = np.concatenate(([0], np.cumsum(windows)))
    at = np.arange(len(head)) - np.repeat(words.first[:-1] - words.first[0], words.counts)
    window = (np.repeat(first[:-1], words.counts) + at // VARIETY_WORDS).astype(np.uint64)
    key = np.sort((window << np.uint64(40)) ^ ((head * np.uint64(2654435761) + tail) & np.uint64(2**40 - 1)))
    new = np.concatenate(([True], key[1:] != key[:-1])) if len(key) else np.zeros(0, bool)
    of_text = np.repeat(np.arange(len(windows)), windows)[(key[new] >> np.uint64(40)).astype(np.int64)]
    return np.bincount(of_text, minlength=len(windows)) / np.maximum(words.counts, 1)


def votes(words: Words, markers: np.ndarray) -> np.ndarray:
    """(texts, labellers) votes."""
    n = np.maximum(words.counts, 1).astype(float)
    head, tail = words.affixes()
    six, _ = words.affixes(6, 0)
    buf = words.buf
    at = np.concatenate(([0], np.cumsum(words.end - words.start)))[words.first]  # offsets in the bytes of words
    solid = buf[(buf != 32) & ~((buf >= 9) & (buf <= 13))]
    size = np.maximum(np.diff(at), 1).astype(float)
    share = lambda m: segment_sums(m, at) / size
    letter = ((solid | 32) >= 97) & ((solid | 32) <= 122)
    digit = (solid >= 48) & (solid <= 57)
    plain = np.isin(solid, np.frombuffer(b".,;:'\"()-?", np.uint8)) | (solid >= 128)
    odd = ~(letter | digit | plain)
    symbols, capitals = share(odd), share((solid >= 65) & (solid <= 90))
    of_words = np.concatenate(([0], np.cumsum(words.end - words.start)))
    signs = segment_sums(segment_sums(odd, of_words) > 0, words.first) / n
    last = buf[np.maximum(words.end - 1, 0)] if len(words.end) else np.zeros(0, np.uint8)
    stops = segment_sums((last == 46) | (last == 33) | (last == 63), words.first) / n
    distinct = variety(words, head, tail)
    same = np.concatenate(((head[1:] == head[:-1]) & (tail[1:] == tail[:-1]), [False])) if len(head) else np.zeros(0, bool)
    repeat = segment_sums(same, words.first) / n
    shout = segment_sums((tail >> np.uint64(8)) == np.uint64(0x2121), words.first) / n
    insult = segment_sums(np.isin(six, INSULT_HEADS), words.first)
    marked = segment_sums(np.isin(head, markers), words.first)
    pick = lambda bad, good, b=JUNK: np.where(bad, b, np.where(good, GOOD, NONE))
    return np.stack(
        [
            pick(symbols > 0.03, symbols < 0.01),
            pick((signs > 0.1) & (n > 20), signs < 0.02),
            pick(capitals > 0.3, (capitals > 0) & (capitals < 0.15)),
            pick((distinct < 0.35) & (n > 20), distinct > 0.45),
            pick(repeat > 0.15, repeat < 0.05),
            pick(shout > 0.1, np.zeros(len(n), bool)),
            pick(((stops < 0.02) | (stops > 0.35)) & (n > 50), (stops > 0.04) & (stops < 0.2)),
            pick(np.zeros(len(n), bool), words.counts >= 10),  # a short text is no fault
            pick(insult > 0, np.zeros(len(n), bool), TOXIC),
            pick(marked > 0, marked == 0, TOXIC),
            pick(marked > 1, np.zeros(len(n), bool), TOXIC),
        ],
        axis=1,
    ).astype(np.int8)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500, prior: float = PRIOR) -> tuple[np.ndarray, np.ndarray]:
    """EM: (posterior of each pattern by class, P(vote | class) as (labellers, classes, votes)).

    It starts from the vote: a class that some labeller names takes most of the pattern, toxic before junk. Each
    round counts votes by class, with `prior` documents more that vote as is assumed: for their class if it
    is bad, rarely for another, and with no say or a passed test otherwise.
    """
    k = patterns.shape[1]
    cast = np.stack([[(patterns[:, j] == v).astype(float) for v in range(4)] for j in range(k)])  # (labellers, votes, patterns)
    named = np.stack([(patterns == JUNK).any(1), (patterns == TOXIC).any(1)], 1)
    post = np.full((len(patterns), len(CLASSES)), 0.05)
    post[np.arange(len(patterns)), np.where(named[:, 1], 2, np.where(named[:, 0], 1, 0))] = 0.9
    assumed = np.array([[0.3, 0.68, 0.01, 0.01], [0.3, 0.39, 0.3, 0.01], [0.3, 0.39, 0.01, 0.3]]) * prior
    for _ in range(rounds):
        weight = post * counts[:, None]
        share = weight.sum(0) + prior
        votes_of = np.einsum("jvp,pc->jcv", cast, weight) + assumed
        votes_of /= votes_of.sum(2, keepdims=True)
        log = np.log(share / share.sum()) + np.einsum("jvp,jcv->pc", cast, np.log(votes_of))
        new = np.exp(log - log.max(1, keepdims=True))
        new /= new.sum(1, keepdims=True)
        moved, post = np.abs(new - post).max(initial=0), new
        if moved < 1e-7:
            break
    return post, votes_of


def _code(v: np.ndarray) -> np.ndarray:
    return (v.astype(np.int64) * 4 ** np.arange(v.shape[1])).sum(1)


class WeakLabelModel:
    """Markers, posteriors of vote patterns, and the scorer.

    No labels give no markers; an empty corpus a model that calls everything good.
    """

    def __init__(self, docs: DataFrame, labels: DataFrame):
        markers = self.markers = mine_heads(labelled_sample(docs, labels, MARKER_ROWS).where("quality = 1"))

        def patterns(batches):
            for b in batches:
                code = [_code(votes(words, markers)) for _, _, words in word_chunks(b.column(2))]
                yield pa.record_batch([b.column(0), b.column(1), pa.array(np.concatenate(code) if code else np.zeros(0, np.int64))], ["d", "t", "code"])

        voted = durable(docs.select(*key_columns(), "text").mapInArrow(patterns, "d bigint, t bigint, code bigint"))
        counts = voted.groupBy("code").count().orderBy("code").collect()
        self.codes = np.array([r["code"] for r in counts], np.int64)
        self.patterns = (self.codes[:, None] // 4 ** np.arange(len(LABELLERS))) % 4
        self.posterior, self.likely = estimate(self.patterns, np.array([r["count"] for r in counts], float)) if counts else (np.zeros((0, 3)), None)
        chosen = voted.select("d", "t").distinct().orderBy(F.xxhash64("d", "t"), "d", "t").limit(TRAIN_ROWS)
        posterior_of = self.posterior_of

        def features(batches):
            for b in batches:
                for i, n, words in word_chunks(b.column(2)):
                    off, idx = hashed_features(words)
                    p = posterior_of(_code(votes(words, markers)))
                    yield pa.record_batch([b.column(0)[i : i + n], b.column(1)[i : i + n], pa.array([x.tobytes() for x in p.astype("<f8")], pa.binary()), pa.array([idx[a:z].astype("<i4").tobytes() for a, z in zip(off[:-1], off[1:])], pa.binary())], ["d", "t", "p", "f"])

        sample = docs.select(*key_columns(), "text").join(F.broadcast(chosen), ["d", "t"]).mapInArrow(features, "d bigint, t bigint, p binary, f binary").orderBy("d", "t").toArrow()
        f = [np.frombuffer(x, "<i4") for x in sample.column("f").to_pylist()]
        off = np.concatenate(([0], np.cumsum([len(x) for x in f]))).astype(np.int64)
        target = np.frombuffer(b"".join(sample.column("p").to_pylist()), "<f8").reshape(-1, len(CLASSES)) if f else np.array([[1.0, 0, 0]])
        self.w, self.bias = fit_softmax(off, np.concatenate(f), target, 1 << FEATURE_BITS) if f else (np.zeros((1 << FEATURE_BITS, 3), np.float32), np.array([5, 0, 0], np.float32))

    def posterior_of(self, code: np.ndarray) -> np.ndarray:
        return self.posterior[np.searchsorted(self.codes, code)]


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, label, posterior_good, score_good, keep) of every row.

    label: the class of most posterior (the first in CLASSES on a tie); keep: both the
    weak labels and the scorer give good at least half. Null and empty texts are texts of no words. Repeated
    rows repeat; null ids stay null. An empty table gives no rows; extra columns are
    ignored.
    """
    model = WeakLabelModel(docs, labels)
    markers, w, bias, posterior_of = model.markers, model.w, model.bias, model.posterior_of
    del model.w

    def run(batches):
        for b in batches:
            for i, n, words in word_chunks(b.column(1)):
                p = posterior_of(_code(votes(words, markers)))
                s = softmax_scores(words, w, bias)[:, 0]
                label = pa.array(np.array(CLASSES)[p.argmax(1)], pa.string())
                yield pa.record_batch([b.column(0)[i : i + n], label, pa.array(np.round(p[:, 0], 6)), pa.array(np.round(s, 6)), pa.array((p[:, 0] >= 0.5) & (s >= 0.5))], ["doc_id", "label", "posterior_good", "score_good", "keep"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, label string, posterior_good double, score_good double, keep boolean")
