"""Near-duplicates of a benchmark: n-grams, MinHash signatures, banded join, exact check."""

from __future__ import annotations

import hashlib
import math
import re
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


NGRAM, MIN_TOKENS, PERMUTATIONS, THRESHOLD = 3, 5, 128, 0.8
#: functions.tokens in Python: white space is that of ASCII.
WORDS = re.compile(r"[A-Za-z0-9_]+|[^ \t\n\x0b\f\rA-Za-z0-9_]")


def ngrams(words: Column, n: int = NGRAM, least: int = MIN_TOKENS) -> Column:
    """Distinct n-grams, joined by blanks; none for fewer than `least` words."""
    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " "))
    return F.when(F.size(words) >= max(least, n), F.array_distinct(windows)).otherwise(F.array().cast("array<string>"))


def with_ngrams(df: DataFrame, key: str, text: str, n: int = NGRAM) -> DataFrame:
    """(key, grams) as of `ngrams` over the tokens of the lower-case text, some documents at a time."""
    some = df.select(key, F.lower(F.coalesce(text, F.lit(""))).alias("text"))

    def grams(lower: str) -> list[str]:
        words = WORDS.findall(lower)
        return list(dict.fromkeys(map(" ".join, zip(*(words[i:] for i in range(n)))))) if len(words) >= max(MIN_TOKENS, n) else []

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                made = pa.array(map(grams, part.column(1).to_pylist()), pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(0), made], [key, "grams"])

    return some.mapInArrow(run, f"`{key}` {some.schema[key].dataType.simpleString()}, grams array<string>")


def bands(permutations: int = PERMUTATIONS, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(bands, rows) whose S-curve has the least sum of areas of misses and false alarms around the threshold."""
    best = (float("inf"), 1, 1)
    for b in range(1, permutations + 1):
        for r in range(1, permutations // b + 1):
            steps = [(k + 0.5) / 1000 for k in range(1000)]
            error = sum(1 - (1 - s**r) ** b if s < threshold else (1 - s**r) ** b for s in steps)
            best = min(best, (error, b, r))
    return best[1], best[2]


def bands_for_recall(threshold: float, recall: float) -> tuple[int, int]:
    """(bands, rows) with the most rows, of at most PERMUTATIONS in all, that find a pair at the threshold with chance `recall`."""
    found = [(math.ceil(math.log(1 - recall) / math.log(1 - threshold**r)), r) for r in range(1, 17)]
    return max(((b, r) for b, r in found if b * r <= PERMUTATIONS), key=lambda x: x[1], default=found[0])


def signature(grams: Column, permutations: int = PERMUTATIONS) -> Column:
    """The least hash of the n-grams under each of some permutations; nothing for no n-gram.

    N-grams are hashed in the JVM; a batch of those hashes is permuted at a time.
    """

    @F.pandas_udf("array<bigint>")
    def least(hashed: pd.Series) -> pd.Series:
        rng = np.random.default_rng(128)
        a = rng.integers(0, 2**63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        b = rng.integers(0, 2**63, permutations, dtype=np.uint64)
        sizes = hashed.map(len).to_numpy(np.int64)
        some = np.flatnonzero(sizes)
        out = np.empty((len(some), permutations), np.int64)
        if len(some):
            flat = np.concatenate([np.asarray(h, np.int64) for h in hashed.iloc[some]]).view(np.uint64)
            ends = np.cumsum(sizes[some])
            at = 0
            while at < len(some):  # as many rows as the processor's cache holds, at least one
                begin = ends[at] - sizes[some[at]]
                upto = max(at + 1, int(np.searchsorted(ends, begin + 32_768, "right")))
                part, first = flat[begin : ends[upto - 1]], ends[at:upto] - sizes[some[at:upto]] - begin
                for k in range(permutations):
                    out[at:upto, k] = np.minimum.reduceat((part * a[k] + b[k]) >> np.uint64(1), first).view(np.int64)
                at = upto
        rows = [np.zeros(0, np.int64)] * len(hashed)
        for i, r in zip(some, out):
            rows[i] = r
        return pd.Series(rows, dtype=object)

    return least(F.transform(grams, lambda g: F.xxhash64(g)))


def overlap(left: DataFrame, right: DataFrame, threshold: float, pairs: DataFrame | None = None) -> DataFrame:
    """(src, tgt, jaccard) of at least `threshold`, exactly, by joining on n-grams. left, right: (id, grams)."""
    a = left.select(F.col("id").alias("src"), F.size("grams").alias("na"), F.explode("grams").alias("g"))
    b = right.select(F.col("id").alias("tgt"), F.size("grams").alias("nb"), F.explode("grams").alias("g"))
    if pairs is not None:
        a = a.join(pairs.select("src").distinct(), "src", "left_semi")
    both = a.join(b, "g").groupBy("src", "tgt", "na", "nb").count()
    return both.select("src", "tgt", (F.col("count") / (F.col("na") + F.col("nb") - F.col("count"))).alias("jaccard")).where(F.col("jaccard") >= threshold)


def candidates(left: DataFrame, right: DataFrame, threshold: float = THRESHOLD, permutations: int = PERMUTATIONS, recall: float | None = None) -> DataFrame:
    """(src, tgt) pairs that share a band of their signatures. With `recall`, bands are made for that chance at the threshold."""
    b, r = bands(permutations, threshold) if recall is None else bands_for_recall(threshold, recall)

    def banded(df: DataFrame, name: str) -> DataFrame:
        signed = df.where(F.size("grams") > 0).select(F.col("id").alias(name), F.explode(F.array(signature(F.col("grams"), b * r))).alias("s"))
        keys = F.array(*[F.xxhash64(F.lit(k), F.slice("s", k * r + 1, r)) for k in range(b)])
        return signed.select(name, F.explode(keys).alias("key"))

    return banded(left, "src").join(banded(right, "tgt"), "key").select("src", "tgt").distinct()


def contaminated(corpus: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, recall: float | None = None) -> DataFrame:
    """(tgt, src[]): for each benchmark item the corpus rows in its bands, unverified, sorted."""
    return candidates(corpus, benchmark, threshold, recall=recall).groupBy("tgt").agg(F.sort_array(F.collect_set("src")).alias("src"))


def without(corpus: DataFrame, found: DataFrame, key: str = "id") -> DataFrame:
    """The corpus less the rows that a dedup report names."""
    return corpus.join(found.select(F.explode("src").alias(key)).distinct(), key, "left_anti")


def sha1_signature(words: list[str], size: int = 100) -> list[bytes]:
    """160-bit signature: least sha1(shingle) xor sha1(seed), over trigrams and the last two shorter ends.

    The least is found by the first 64 bits of all, and by the rest where those are equal.
    """
    shown = list(map(repr, words))
    shingles = {f"({a}, {b}, {c})" for a, b, c in zip(shown, shown[1:], shown[2:])} | {f"({', '.join(x)}{',' if len(x) < 2 else ''})" for x in (shown[-2:], shown[-1:])}
    if not shown:
        return [(2**160 - 1).to_bytes(20, "big")] * size
    hashed = np.frombuffer(b"".join([hashlib.sha1(x.encode()).digest() for x in shingles]), np.uint8).reshape(-1, 20)
    return _least_mixed(hashed, _seeds(size))


@cache
def _seeds(size: int) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.sha1(str(i).encode()).digest() for i in range(size)), np.uint8).reshape(-1, 20)


def _least_mixed(hashed: np.ndarray, seeds: np.ndarray) -> list[bytes]:
    """For each seed the least of all hashes xor the seed, all of 20 bytes."""
    top, mask = (np.ascontiguousarray(x[:, :8]).view(">u8").ravel().astype(np.uint64) for x in (hashed, seeds))
    if len(np.unique(top)) == len(top):
        some = max(1, 100_000 // len(top))
        best = np.concatenate([(mask[k : k + some, None] ^ top).argmin(1) for k in range(0, len(mask), some)])
        flat = (hashed[best] ^ seeds).tobytes()
        return [flat[i : i + 20] for i in range(0, len(flat), 20)]
    ties = [np.flatnonzero((top ^ m) == (top ^ m).min()) for m in mask]
    return [min((h ^ seed).tobytes() for h in hashed[t]) for seed, t in zip(seeds, ties)]


def sha1_signatures(words: Column) -> Column:
    """sha1_signature of arrays of words, or of the tokens of texts."""

    @F.pandas_udf("array<binary>")
    def run(batch: pd.Series) -> pd.Series:
        return batch.map(lambda w: sha1_signature([] if w is None else WORDS.findall(w) if isinstance(w, str) else list(w)))

    return run(words)


def agreement(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: p["a"] == p["b"])) / F.size(a)


def similar_pairs(left: DataFrame, right: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(src, tgt, score): every pair of (id, words or text) rows whose 160-bit signatures agree above the threshold.

    Signatures that agree above it share a position, so that the join is on (position,
    value) and not of all with all.
    """

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.select(F.col("id").alias(name), F.posexplode(sha1_signatures(F.col("words" if "words" in df.columns else "text"))).alias("k", "v"))

    pairs = rows(left, "src").join(rows(right, "tgt"), ["k", "v"]).groupBy("src", "tgt").count()
    return pairs.select("src", "tgt", (F.col("count") / 100).alias("score")).where(F.col("score") > threshold)
