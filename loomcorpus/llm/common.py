"""Shared pieces of the training-data operators: durable checkpoints, vectorised
word hashing over Arrow buffers, hashed word features and labelled samples."""

from __future__ import annotations

import ctypes
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NO_ID = -(2**63)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 2**64)
_POW = {"n": 0}
_LIBC = ctypes.CDLL(None)


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it isn't set, one of its own in local mode, and an error on a cluster."""
    sc = spark.sparkContext
    at = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not at and sc.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir isn't set; it must name a folder that all executors share")
    if not at:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="ckpt-"))
        at = sc.getCheckpointDir()
    return at.rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage through the folder all executors share."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def release() -> None:
    """Give the memory that a task freed back to the system; its Python worker stays for the tasks after it."""
    _POW.update(n=0, up=None, down=None)
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def key_columns() -> list[Column]:
    """Row identity: (document id, hash of text). Null ids and texts are values like any other."""
    return [F.coalesce(F.col("doc_id"), F.lit(NO_ID)).cast("bigint").alias("d"), F.xxhash64("text").alias("t")]


def with_key(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """docs with its two key columns, and their names, which no other column has."""
    names = [unused(docs.columns, "__key_d"), unused(docs.columns, "__key_t")]
    return docs.withColumns(dict(zip(names, key_columns()))), names


def unused(columns: list[str], name: str) -> str:
    """The name, with as many underscores before it as keep it apart from the columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, elementwise."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _POW["n"] < n:
        size = max(n, 1 << 20)
        for name, b in (("up", _BASE), ("down", _INV)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            _POW[name] = np.multiply.accumulate(p)
        _POW["n"] = size
    return _POW["up"][:n], _POW["down"][:n]


class Words:
    """Words (runs of bytes other than ASCII white space) of some texts.

    buf: the texts' bytes, a space after each; start, end: word bounds in buf;
    first: index of each text's first word, with the total at the end.
    """

    def __init__(self, buf: np.ndarray, text_start: np.ndarray):
        self.buf = buf
        space = (buf == 32) | ((buf >= 9) & (buf <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True]))))
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.start, text_start)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, equal in every process."""
        n = len(self.buf)
        if not len(self.start):
            return np.zeros(0, np.uint64)
        up, down = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
        return mix64((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))

    def affixes(self, head: int = 4, tail: int = 3) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the first and of the last bytes of each word (ASCII case ignored in the first)."""
        low = np.concatenate((self.buf, np.zeros(8, np.uint8)))
        low = np.where((low >= 65) & (low <= 90), low + 32, low)
        size = self.end - self.start
        a = np.zeros(len(size), np.uint64)
        for k in range(head):
            a = a * np.uint64(256) + np.where(size > k, low[self.start + k], 0).astype(np.uint64)
        b = np.zeros(len(size), np.uint64)
        for k in range(1, tail + 1):
            b = b * np.uint64(256) + np.where(size >= k, self.buf[np.maximum(self.end - k, 0)], 0).astype(np.uint64)
        return a, b


def word_chunks(texts: pa.Array, chunk_bytes: int = 1 << 20):
    """Yield (first row, number of rows, Words) over a string array; nulls are empty texts."""
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return
    off = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + chunk_bytes, side="right")) - 1
        j = min(max(j, i + 1), n)
        at = off[i : j + 1] - off[i]
        size = int(at[-1])
        ends = at[1:] + np.arange(j - i)  # where each text's closing space goes
        buf = np.full(size + (j - i), 32, np.uint8)
        keep = np.ones(len(buf), bool)
        keep[ends] = False
        buf[keep] = data[off[i] : off[i] + size]
        yield i, j - i, Words(buf, np.concatenate(([0], ends + 1)))
        i = j


FEATURE_BITS = 17


def hashed_features(words: Words, bits: int = FEATURE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of each text: (offsets, indices).

    Features are word heads and tails, and classes of length with the share of distinct
    ones among them and with the share of words that repeat the one before.
    """
    a, b = words.affixes()
    texts = np.arange(len(words.counts), dtype=np.uint64)
    row = np.repeat(texts, words.counts) << np.uint64(bits)
    low = np.uint64((1 << bits) - 1)
    keys = np.concatenate((row | (mix64(a) & low), row | (mix64(b + np.uint64(1 << 40)) & low)))
    keys.sort()
    if len(keys):
        keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
    bounds = np.append(texts, np.uint64(len(texts))) << np.uint64(bits)
    n = np.maximum(words.counts, 1)
    distinct = np.diff(np.searchsorted(keys, bounds)) / (2 * n)
    same = np.concatenate(((a[1:] == a[:-1]) & (b[1:] == b[:-1]), [False])) if len(a) else np.zeros(0, bool)
    repeats = segment_sums(same, words.first) / n
    size = np.minimum(np.log2(n + 1), 15).astype(np.uint64) * np.uint64(64)
    shape = [mix64(size + (np.clip(x, 0, 1) * 20).astype(np.uint64) + np.uint64(k << 41)) & low for k, x in ((1, distinct), (2, repeats))]
    keys = np.concatenate((keys, *[(texts << np.uint64(bits)) | x for x in shape]))
    keys.sort()
    return np.searchsorted(keys, bounds), (keys & low).astype(np.int32)


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values over consecutive segments; an empty segment gives 0."""
    total = np.concatenate((np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def labelled_sample(docs: DataFrame, labels: DataFrame, n: int) -> DataFrame:
    """At most n documents that have labels, drawn by a hash of the id: (doc_id, text, quality, toxic), one row for an id.

    n is the bound of everything that is fitted on the driver; the sample of labels is
    small enough to be broadcast for any size of the corpus. Of several labels of an id the least
    (quality, toxic) counts, and of several texts the least by (hash, text). Nulls take no part.
    """
    chosen = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and quality is not null and toxic is not null")
    chosen = chosen.groupBy("doc_id").agg(F.min(F.struct("quality", "toxic")).alias("l")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).select("doc_id", "l.*")
    found = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    one = found.groupBy("doc_id", "quality", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("x"))
    return one.select("doc_id", "x.text", "quality", "toxic")


def fit_softmax(offsets: np.ndarray, idx: np.ndarray, target: np.ndarray, size: int, steps: int = 80, l2: float = 1e-5, rate: float = 0.3) -> tuple[np.ndarray, np.ndarray]:
    """Multinomial logistic regression on binary sparse features by full-batch Adagrad.

    target: (rows, classes), each row a distribution. Features count 1/sqrt(sqrt(number in
    the row)) to the score. Returns (weights, bias).
    """
    rows, classes = target.shape
    w = np.zeros((size, classes))
    if not rows:
        return w.astype(np.float32), np.zeros(classes, np.float32)
    bias = np.log(target.mean(0) + 1e-6)
    counts = np.diff(offsets)
    scale = np.maximum(counts, 1) ** -0.25
    used = np.unique(idx)
    place = np.zeros(size, np.int32)
    place[used] = np.arange(len(used), dtype=np.int32)
    where = place[idx]
    v, gw, gb = np.zeros((len(used), classes)), np.full((len(used), classes), 1e-8), np.full(classes, 1e-8)
    s, g = np.empty((rows, classes)), np.empty_like(v)
    for _ in range(steps):
        for c in range(classes):  # one class at a time: the driver holds one number for each feature, not one for each class
            s[:, c] = segment_sums(v[:, c][where], offsets) * scale + bias[c]
        p = np.exp(s - s.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        e = (p - target) / rows
        for c in range(classes):
            g[:, c] = np.bincount(where, np.repeat(e[:, c] * scale, counts), len(used)) + l2 * v[:, c]
        gw += g * g
        v -= rate * g / np.sqrt(gw)
        b = e.sum(0)
        gb += b * b
        bias = bias - rate * 0.2 * b / np.sqrt(gb)
    w[used] = v
    return w.astype(np.float32), bias.astype(np.float32)


def softmax_scores(words: Words, w: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Class probabilities of each text under fit_softmax's model."""
    offsets, idx = hashed_features(words)
    s = segment_sums(w[idx], offsets) * (np.maximum(np.diff(offsets), 1) ** -0.25)[:, None] + bias
    p = np.exp(s - s.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)
