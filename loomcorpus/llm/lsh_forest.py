"""MinHash near-dedup: LSH forest.

Each document's MinHash signature gives TREES labels of DEPTH hashes; a tree of the forest is the
sorted order of the labels of one kind. Candidates of a document are its NEIGHBOURS nearest in each
order on both sides, with which it has the longest common prefixes, of MIN_DEPTH hashes at least; so the
depth at which it finds them is its own, great where a region of the tree is crowded and small
where it is not. Where more documents than that share MIN_DEPTH hashes, those that the neighbours leave apart
are then compared: every document that has been reached from a group's first meets all that no
group has yet, so that a region of any size links exactly what all its pairs would, and in a family of
similar documents the rest shrinks with each step.

Equal signatures are collapsed before the forest, so thousands of exact copies cost one
entry and one link each. Verified pairs become groups by alternating large-star and small-star rounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, key_columns, mix64, release, unused, with_key, word_chunks

SHINGLE = 3
HASHES = 128
TREES, DEPTH, MIN_DEPTH = 16, 8, 3
NEIGHBOURS = 4
THRESHOLD = 0.55
_rng = np.random.default_rng(20240917)
_A = _rng.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)


def shingles(h: np.ndarray, first: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets) of each text's k-word shingles; a shorter text is one shingle, an empty one none."""
    n = np.diff(first)
    take = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    offsets = np.concatenate(([0], np.cumsum(take)))
    at = np.repeat(first[:-1] - offsets[:-1], take) + np.arange(offsets[-1])
    last = np.repeat(first[1:], take)
    s = np.zeros(len(at), np.uint64)
    for j in range(k):
        inside = at + j < last
        s = mix64(s + np.where(inside, h[np.minimum(at + j, max(len(h) - 1, 0))], np.uint64(j))) if len(h) else s
    return s, offsets


def signatures(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows that have words, their signatures of HASHES 32-bit minima)."""
    s, offsets = shingles(h, first)
    rows = np.flatnonzero(np.diff(offsets))
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(rows), HASHES), np.uint32)
    if len(rows):
        for k in range(HASHES):
            y = x * _A[k] + _B[k]
            out[:, k] = np.minimum.reduceat(y ^ (y >> np.uint32(15)), offsets[rows])
    return rows, out


def _sign(batches):
    for batch in batches:
        d, t, texts = (batch.column(i) for i in range(3))
        for i, n, words in word_chunks(texts):
            rows, sig = signatures(words.hashes(), words.first)
            if len(rows):
                label = np.ascontiguousarray(sig[:, : TREES * DEPTH].astype(">u4"))
                sketch = np.ascontiguousarray(sig.astype(np.uint8))
                wide = sig.astype(np.uint64) + (np.arange(HASHES, dtype=np.uint64) << np.uint64(32))
                whole = [mix64(np.bitwise_xor.reduce(mix64(wide + np.uint64(x)), axis=1)).view(np.int64) for x in (0, 1 << 50)]
                take = pa.array(rows + i)
                yield pa.record_batch([d.take(take), t.take(take), pa.array(whole[0]), pa.array(whole[1]), pa.array([r.tobytes() for r in label], pa.binary()), pa.array([r.tobytes() for r in sketch], pa.binary())], ["d", "t", "w1", "w2", "label", "sketch"])
    release()


def agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of one sketch with many: equal low bytes, less the chance of 1 in 256."""
    same = np.bitwise_count((b == a).view(np.uint64)).sum(axis=-1, dtype=np.int64)
    return (same / b.shape[-1] - 1 / 256) / (1 - 1 / 256)


def neighbour_roots(lcp: np.ndarray, sketches: np.ndarray, threshold: float) -> np.ndarray:
    """Of each row of a sorted order the first row of its group, as far as verified neighbours link them.

    lcp: hashes that a row's label shares with the label before.
    """
    n = len(lcp)
    root = np.arange(n)
    deep = lcp >= MIN_DEPTH  # with the row before
    inside, pairs = np.ones(n, bool), []
    for s in range(1, min(NEIGHBOURS, n - 1) + 1):
        inside = inside[: n - s] & deep[s:]  # rows i and i + s are of one region
        at = np.flatnonzero(inside)
        for a in range(0, len(at), 100_000):
            i = at[a : a + 100_000]
            hit = i[agreement(sketches[i], sketches[i + s]) >= threshold]
            pairs.append(np.stack((hit, hit + s)))
    if pairs:
        u, v = np.concatenate(pairs, 1)
        while True:  # each row takes the least root of those it is linked with, and then that root's root
            before = root.copy()
            low = np.minimum(root[u], root[v])
            np.minimum.at(root, root[u], low)
            np.minimum.at(root, root[v], low)
            np.minimum.at(root, u, low)
            np.minimum.at(root, v, low)
            root = root[root]
            if (root == before).all():
                break
    return root


def close_region(root: np.ndarray, sketches: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links (first, other) that connect what verified pairs of a region connect. root: groups that are linked already."""
    n = len(root)
    order = np.argsort(root, kind="stable")
    members = {int(root[m[0]]): m.tolist() for m in np.split(order, np.flatnonzero(np.diff(root[order])) + 1)}
    if n <= NEIGHBOURS + 1 or len(members) == 1:  # all pairs have met
        return [(r, j) for r, m in members.items() for j in m if j != r]
    out, left, there, new = [], np.arange(n), sketches, np.zeros(n, bool)
    while len(left):
        first = int(left[0])
        reach = list(members[int(root[first])])
        out += [(first, j) for j in reach if j != first]
        if len(reach) == 1:
            left, there = left[1:], there[1:]
        else:
            new[reach] = True
            stay = ~new[left]
            left, there = left[stay], there[stay]
        while reach and len(left):
            hit = agreement(sketches[reach.pop()], there) >= threshold
            if hit.any():
                more = [j for k in np.unique(root[left[hit]]).tolist() for j in members[k]]
                out += [(first, j) for j in more]
                reach += more
                new[more] = True
                stay = ~new[left]
                left, there = left[stay], there[stay]
    return out


def order_edges(tree: np.ndarray, labels: np.ndarray, sketches: np.ndarray, threshold: float) -> np.ndarray:
    """(2, links) between rows of whole regions, in order of (tree, label)."""
    n = len(tree)
    same = np.concatenate((np.zeros((1, labels.shape[1]), bool), (labels[1:] == labels[:-1]) & (tree[1:] == tree[:-1])[:, None]))
    lcp = np.where(same.all(1), labels.shape[1], same.argmin(1))
    root = neighbour_roots(lcp, sketches, threshold)
    cut = np.concatenate((np.flatnonzero(lcp < MIN_DEPTH), [n]))
    edges = [(a + i, a + j) for a, z in zip(cut[:-1].tolist(), cut[1:].tolist()) if z - a > 1 for i, j in close_region(root[a:z] - a, sketches[a:z], threshold)]
    return np.array(edges, np.int64).reshape(-1, 2).T


def _forest(threshold: float):
    def run(batches):
        kept: list[tuple] = []  # rows of the region in hand, which may go on

        def settle(rows: tuple):
            tree, d, t, lab, sk = rows
            i, j = order_edges(tree, lab, sk, threshold)
            if len(i):
                yield pa.record_batch([pa.array(x) for x in (d[i], t[i], d[j], t[j])], ["ud", "ut", "vd", "vt"])

        for batch in batches:
            copies = pc.less(batch.column(0), 0)
            if pc.any(copies).as_py():
                done = batch.filter(copies)
                yield pa.record_batch([done.column(k) for k in (5, 6, 1, 2)], ["ud", "ut", "vd", "vt"])
                batch = batch.filter(pc.invert(copies))
            if not batch.num_rows:
                continue
            lab = np.frombuffer(b"".join(batch.column(3).to_pylist()), ">u4").reshape(-1, DEPTH).astype(np.uint32)
            sk = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(-1, HASHES)
            rows = (batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(), lab, sk)
            other = (rows[0] != rows[0][-1]) | (lab[:, :MIN_DEPTH] != lab[-1, :MIN_DEPTH]).any(1)
            cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            if kept and (cut or kept[-1][0][-1] != rows[0][0] or (kept[-1][3][-1, :MIN_DEPTH] != lab[0, :MIN_DEPTH]).any()):
                kept.append(tuple(x[:cut] for x in rows))
                yield from settle(tuple(np.concatenate(x) for x in zip(*kept)))
                kept = []
            elif cut:
                yield from settle(tuple(x[:cut] for x in rows))
            kept.append(tuple(x[cut:] for x in rows))
        if kept:
            yield from settle(tuple(np.concatenate(x) for x in zip(*kept)))
        release()

    return run


def components(edges: DataFrame) -> DataFrame:
    """(u, root): each node of some edge (u, v) and the least node it is connected with.

    Large-star and small-star in turn until neither changes the edges: a logarithmic
    number of rounds, each a shuffle of the edges alone. The least neighbour is found with partial
    minima and joined, so that a node with many edges is no single task's.
    """

    def stars(e: DataFrame, large: bool) -> DataFrame:
        big, small = F.greatest("u", "v"), F.least("u", "v")
        both = e.select("u", "v").union(e.select("v", "u")).toDF("u", "v") if large else e.select(big.alias("u"), small.alias("v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        if large:
            out = both.where("v > u").join(least, "u").select("v", "m")
        else:
            out = both.join(least, "u").select("v", "m").union(least.select("u", "m"))
        return out.toDF("u", "v").where("u != v").distinct()

    def mark(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges = durable(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct())
    before = mark(edges)
    while before[0]:
        edges = durable(stars(stars(edges, True), False))
        now = mark(edges)
        if now == before:
            break
        before = now
    return edges.select("u", F.col("v").alias("root"))


def near_groups(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(u, root), both struct<d, t>: each document of a group but its first, and the first."""
    docs = docs.where("text is not null").select(*key_columns(), "text")
    signed = docs.mapInArrow(_sign, "d bigint, t bigint, w1 bigint, w2 bigint, label binary, sketch binary")
    one = signed.groupBy("t").agg(F.min("d").alias("d"), *[F.first(c).alias(c) for c in ("w1", "w2", "label", "sketch")])
    # Other texts of equal signature go on as a finished link (tree -1), the first as TREES labels.
    w = Window.partitionBy("w1", "w2").orderBy("d", "t")
    seen = one.withColumns({"k": F.row_number().over(w), "fd": F.first("d").over(w), "ft": F.first("t").over(w)})
    tree = F.explode(F.when(F.col("k") == 1, F.sequence(F.lit(0), F.lit(TREES - 1))).otherwise(F.array(F.lit(-1))))
    rows = seen.select(tree.alias("tree"), "d", "t", "fd", "ft", "label", "sketch")
    of_tree = lambda c: F.expr(f"if(tree < 0, null, {c})")
    rows = rows.select("tree", "d", "t", of_tree(f"substring(label, tree * {4 * DEPTH} + 1, {4 * DEPTH})").alias("label"), of_tree("sketch").alias("sketch"), F.expr("if(tree < 0, fd, null)").alias("fd"), F.expr("if(tree < 0, ft, null)").alias("ft"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    head = F.when(F.col("tree") < 0, F.col("d").cast("string").cast("binary")).otherwise(F.substring("label", 1, 4 * MIN_DEPTH))
    regions = rows.repartition(n, "tree", head).sortWithinPartitions("tree", "label", "d", "t")
    found = regions.mapInArrow(_forest(threshold), "ud bigint, ut bigint, vd bigint, vt bigint")
    groups = components(found.select(F.struct(F.col("ud").alias("d"), F.col("ut").alias("t")).alias("u"), F.struct(F.col("vd").alias("d"), F.col("vt").alias("t")).alias("v")))
    # Copies of a text follow its first document; wordless texts are no copies.
    worded = F.trim(F.translate("text", "\t\n\x0b\x0c\r", "     ")) != ""
    keys = docs.where(worded).select("d", "t").distinct()
    firsts = keys.groupBy("t").agg(F.min("d").alias("d"), F.count("*").alias("n")).where("n > 1").select("t", F.struct("d", "t").alias("f"))
    copies = keys.join(firsts, "t").select(F.struct("d", "t").alias("u"), "f").where("u != f")
    of_copies = copies.join(groups.withColumnRenamed("u", "f"), "f", "left").select("u", F.coalesce("root", "f").alias("root"))
    return groups.unionByName(of_copies)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, keep_doc_id): each document that goes, and the first of its group, which stays.

    Similarity is the estimated Jaccard of 3-word shingles. The first by (doc_id, text
    hash) stays. Null and wordless texts match nothing. Rows equal in id and text are
    one document here. A null id comes back as null. Empty tables give no rows; extra
    columns are ignored.
    """
    g = near_groups(docs, threshold)
    name = lambda c: F.when(F.col(c) != -(2**63), F.col(c))
    return g.select(name("u.d").alias("doc_id"), name("root.d").alias("keep_doc_id"))


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each near-duplicate group, and all documents of no group.

    Columns as they are. Rows equal in id and text are copies: the one whose other columns have the
    least hash stays, unless the text is null or wordless, which match nothing.
    """
    keyed, names = with_key(docs)
    gone = near_groups(docs, threshold).select("u.d", "u.t").toDF(*names)
    blank = F.coalesce(F.trim(F.translate("text", "\t\n\x0b\x0c\r", "     ")) == "", F.lit(True))
    left = keyed.join(gone, names, "left_anti")
    others = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    rank = unused(docs.columns, "__rank")
    one = left.where(~blank).withColumn(rank, F.row_number().over(Window.partitionBy(*names).orderBy(F.xxhash64(*others)))).where(F.col(rank) == 1).drop(rank)
    return one.unionByName(left.where(blank)).select(*[f"`{c}`" for c in docs.columns])
