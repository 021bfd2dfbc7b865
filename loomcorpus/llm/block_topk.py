"""Exact top-k search: block-at-a-time pruning.

Documents go into blocks of consecutive ids. A block has a forward index (the query
terms of each of its documents, with integer BM25 impacts) and the maximum impact of
each term. For each query a task orders its blocks by the sum of the query's term
maxima, scores them through their forward indexes from the highest, and stops at the
first block whose bound is below the k-th best score so far. Each task's best k are
merged. Impacts are integers, so that sums are exact and ties go by document id.

Only terms of queries are indexed; lengths, document frequencies and the number of
documents are over everything. Queries are taken in batches of a bounded number, each a pass.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, release

K = 10
K1, B, SCALE = 1.2, 0.75, 1e6
BLOCK, SEGMENT, QUERIES_A_PASS = 128, 256, 4096
TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def _index(vocabulary: dict[str, int]):
    """A row of kind 0 for each document; a row of kind 1 with document frequencies for each batch."""

    def run(batches):
        get = vocabulary.get
        for b in batches:
            df = np.zeros(len(vocabulary), np.int64)
            size, terms, tfs = [], [], []
            for text in b.column(1).to_pylist():
                words = tokens(text)
                size.append(len(words))
                found, n = np.unique(np.array([i for w in words if (i := get(w)) is not None], np.int64), return_counts=True)
                df[found] += 1
                terms.append(found.astype("<u4").tobytes())
                tfs.append(n.astype("<u4").tobytes())
            yield pa.record_batch([pa.array(np.zeros(len(size), np.int32)), b.column(0), pa.array(size, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())], ["kind", "doc_id", "size", "terms", "tfs"])
            yield pa.record_batch([pa.array([1], pa.int32()), pa.array([None], pa.int64()), pa.array([len(size)], pa.int64()), pa.array([df.astype("<i8").tobytes()], pa.binary()), pa.array([int(sum(size)).to_bytes(8, "little")], pa.binary())], ["kind", "doc_id", "size", "terms", "tfs"])

    return run


def _add_up(batches):
    n = words = 0
    df = None
    for b in batches:
        for size, terms, tfs in zip(*[b.column(k).to_pylist() for k in range(3)]):
            x = np.frombuffer(terms, "<i8")
            df = x if df is None else df + x
            n, words = n + size, words + int.from_bytes(tfs, "little")
    if df is not None:
        yield pa.record_batch([pa.array([n], pa.int64()), pa.array([df.astype("<i8").tobytes()], pa.binary()), pa.array([words.to_bytes(8, "little")], pa.binary())], ["size", "terms", "tfs"])


class Segment:
    """Blocks of BLOCK consecutive rows: their forward indexes, and each term's maxima in the blocks that have it."""

    def __init__(self, terms: list[np.ndarray], impacts: np.ndarray, first: int):
        n = np.array([len(x) for x in terms])
        self.first, self.rows = first, len(terms)
        row, self.term, self.impact = np.repeat(np.arange(len(terms)), n), np.concatenate(terms).astype(np.int64), impacts
        self.count = -(-len(terms) // BLOCK)
        self.cut = np.searchsorted(row, np.arange(self.count + 1) * BLOCK)
        self.local = row % BLOCK
        order = np.lexsort((row // BLOCK, self.term))
        block, term = (row // BLOCK)[order], self.term[order]
        new = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (block[1:] != block[:-1])))) if len(term) else np.zeros(0, np.int64)
        self.most = np.maximum.reduceat(impacts[order], new) if len(new) else np.zeros(0, np.int64)
        self.of_term, self.of_block = term[new], block[new]

    def bounds(self, terms: np.ndarray) -> np.ndarray:
        """Of each block the sum of the terms' maxima."""
        a, z = np.searchsorted(self.of_term, terms, side="left"), np.searchsorted(self.of_term, terms, side="right")
        at = np.concatenate([np.arange(i, j) for i, j in zip(a, z)]) if len(terms) else np.zeros(0, np.int64)
        out = np.zeros(self.count, np.int64)
        np.add.at(out, self.of_block[at], self.most[at])
        return out

    def best(self, terms: np.ndarray, k: int, best: np.ndarray) -> np.ndarray:
        """(score, row) of the best k by (-score, row), those in `best` of earlier rows among them."""
        bound = self.bounds(terms)
        for x in np.argsort(-bound, kind="stable"):
            if bound[x] == 0 or (len(best) == k and bound[x] < best[-1, 0]):
                break
            own = slice(self.cut[x], self.cut[x + 1])
            at = np.searchsorted(terms, self.term[own])
            hit = terms[np.minimum(at, len(terms) - 1)] == self.term[own]
            score = np.zeros(BLOCK, np.int64)
            np.add.at(score, self.local[own][hit], self.impact[own][hit])
            some = np.flatnonzero(score >= (max(best[-1, 0], 1) if len(best) == k else 1))
            if len(some):
                best = np.concatenate((best, np.stack((score[some], some + x * BLOCK + self.first), 1)))
                best = best[np.lexsort((best[:, 1], -best[:, 0]))][:k]
        return best


def _search(queries: list[tuple[int, np.ndarray]], idf: np.ndarray, mean: float, k: int):
    def run(batches):
        best = {q: np.zeros((0, 2), np.int64) for q, _ in queries}
        ids: dict[int, int | None] = {}  # of the rows in best
        held, size, done = [], 0, 0

        def settle():
            nonlocal ids, done
            doc_ids = [x for b in held for x in b.column(0).to_pylist()]
            length = np.concatenate([b.column(1).to_numpy() for b in held])
            terms, tfs = ([np.frombuffer(x, "<u4") for b in held for x in b.column(c).to_pylist()] for c in (2, 3))
            n = np.array([len(x) for x in terms])
            term, tf, long = np.concatenate(terms).astype(np.int64), np.concatenate(tfs).astype(np.float64), np.repeat(length, n)
            impact = np.floor(SCALE * idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * long / mean)) + 0.5).astype(np.int64)
            segment = Segment(terms, impact, done)
            for q, t in queries:
                best[q] = segment.best(t, k, best[q])
            kept = {int(r) for x in best.values() for r in x[:, 1]}
            ids = {r: ids[r] if r < done else doc_ids[r - done] for r in kept}
            done += len(doc_ids)

        for b in batches:
            for at in range(0, b.num_rows, SEGMENT * BLOCK):
                part = b.slice(at, SEGMENT * BLOCK)
                if size + part.num_rows > SEGMENT * BLOCK and held:
                    settle()
                    held, size = [], 0
                held.append(part)
                size += part.num_rows
        if size:
            settle()
        found = [(q, ids[int(r)], int(x)) for q, top in best.items() for x, r in top]
        if found:
            q, d, s = zip(*found)
            yield pa.record_batch([pa.array(q, pa.int32()), pa.array(d, pa.int64()), pa.array(s, pa.int64())], ["q", "doc_id", "score"])
        release()

    return run


def search(queries: DataFrame, docs: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every row of `queries`.

    BM25 over distinct lower-cased words, impacts rounded to millionths; equal scores go by
    doc_id, null first. A document without a word of the query is no match, so a query
    may have fewer than k rows, and a null, empty or wordless one none. Repeated rows
    of documents rank side by side; repeated queries each get their rows. A null or
    empty text is a document of 0 words. Empty tables give no rows. Extra columns are
    ignored.
    """
    spark = docs.sparkSession
    asked = queries.select(F.col("item_id").cast("bigint").alias("item_id"), "text").orderBy("item_id", "text")
    passes = max(1, -(-asked.count() // QUERIES_A_PASS))
    out = None
    for part in range(passes):
        mine = asked if passes == 1 else asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == part)
        found = _one_pass(mine.collect(), docs, k)
        out = found if out is None else out.union(found)
    return out


def _one_pass(asked, docs: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    words = [sorted(set(tokens(r["text"]))) for r in asked]
    vocabulary = {w: i for i, w in enumerate(sorted(set().union(*words)))} if words else {}
    empty = spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    if not vocabulary:
        return empty
    index = durable(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_index(vocabulary), "kind int, doc_id bigint, size bigint, terms binary, tfs binary"))
    sums = index.where("kind = 1").select("size", "terms", "tfs").mapInArrow(_add_up, "size bigint, terms binary, tfs binary")
    total = list(_add_up(sums.repartition(1).mapInArrow(_add_up, "size bigint, terms binary, tfs binary").toArrow().to_batches()))
    if not total:
        return empty
    n, df, length = total[0].column(0)[0].as_py(), np.frombuffer(total[0].column(1)[0].as_py(), "<i8"), int.from_bytes(total[0].column(2)[0].as_py(), "little")
    idf = np.array([math.log(1 + (n - x + 0.5) / (x + 0.5)) for x in df.tolist()])
    terms = [(q, np.array([vocabulary[w] for w in ws], np.int64)) for q, ws in enumerate(words) if ws]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = index.where("kind = 0 and length(terms) > 0").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id").select("doc_id", "size", "terms", "tfs")
    found = ranges.mapInArrow(_search(terms, idf, max(length / max(n, 1), 1e-9), k), "q int, doc_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "doc_id"))
    best = found.withColumn("rank", place).where(F.col("rank") <= k)
    names = spark.createDataFrame([(q, r["item_id"]) for q, r in enumerate(asked)], "q int, item_id bigint")
    return best.join(F.broadcast(names), "q").select("item_id", "rank", "doc_id", "score")


SQL = rf"""
with t as (select doc_id, len(regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+')) as size, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) as w from documents),
s as (select count(*) as n, sum(len(regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}]+'))) / count(*) as mean from documents),
q as (select distinct item_id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+')) as w from benchmark),
f as (select doc_id, any_value(size) as size, w, count(*) as tf from t where w in (select w from q) group by doc_id, w),
d as (select w, ln(1 + ((select n from s) - count(*) + 0.5) / (count(*) + 0.5)) as idf from f group by w),
i as (select doc_id, w, cast(floor({SCALE} * idf * tf * {K1 + 1} / (tf + {K1} * ({1 - B} + {B} * size / (select mean from s))) + 0.5) as bigint) as impact from f join d using (w)),
r as (select item_id, doc_id, cast(sum(impact) as bigint) as score from q join i using (w) group by item_id, doc_id)
select item_id, cast(rank as int) as rank, doc_id, score from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from r) where rank <= {K}
"""
