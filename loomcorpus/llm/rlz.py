"""Substring dedup: relative Lempel-Ziv parsing.

Every document is parsed greedily into factors, longest matches in earlier documents; factors of
MIN_WORDS words or more are duplicate spans. As no shorter factor counts, the reference is
indexed by windows of MIN_WORDS words, by 96 bits of hash, each at its first place in the corpus. That
place is the window's name: two texts agree over a stretch if their windows have the same names there. So
each document is rewritten as runs, (where, length, first place), of which there are few, and parsing needs
no texts. A document has a run's windows from its first place on; and where a stretch passes from run to
run, the first document that passed through the same runs has as much of it, and of the runs at its two ends
as they go on together. Passages through 1 to 8, 10, 12, 14, 16, 20, ... runs (STEPS) are looked up so. From
the first window that is not in a factor yet, the match that goes on longest gives the factor. The next
factor may begin inside the one before: windows over a factor's boundary are windows like any other.

The index is cut into blocks by hash, and every document meets every block, each with those of its
windows that hash there. Blocks are sorted outside memory, so that a window that most documents have is
a long run of rows and nothing that must be held.

Only windows that can repeat are sent. The least hash of ANCHOR words inside a window is
its anchor, shared by most windows next to it and by all its copies; anchors are counted
first, and a window whose anchor one text alone has can't repeat. That filter
loses nothing. Copies of a whole text are settled by its hash and go no further.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import NO_ID, Words, _powers, durable, key_columns, mix64, release, word_chunks

MIN_WORDS, ANCHOR = 50, 20
#: Runs that looked-up passages go through: four numbers for each doubling.
STEPS = (*range(1, 8), *(q << j for j in range(1, 20) for q in range(4, 8)))


def grams(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on; what runs over the end of a text is for the caller to leave out."""
    n = len(h)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix64(h) * up[:n], out=total[1:])
    return mix64((total[k:] - total[:-k]) * down[: n - k + 1])


def _slide(x: np.ndarray, w: int, op) -> np.ndarray:
    """op over each w consecutive values, by doubling."""
    size, out = 1, x
    while size * 2 <= w:
        out = op(out[:-size], out[size:])
        size *= 2
    return op(out[: len(out) - (w - size)], out[w - size :]) if size < w else out


def anchors(words: Words, h: np.ndarray, min_words: int = MIN_WORDS, k: int = ANCHOR) -> np.ndarray:
    """For each window of min_words words the least hash of k words inside, its anchor; 0 over a text's end."""
    g, w = grams(h, k), min_words - k + 1
    if len(g) < w:
        return np.zeros(0, np.uint64)
    low = _slide(np.maximum(g, np.uint64(1)), w, np.minimum)
    end = np.repeat(words.first[1:], words.counts)
    return np.where(np.arange(len(low)) + min_words <= end[: len(low)], low, np.uint64(0))


def _runs(x: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)


def _anchor_rows(min_words: int, k: int):
    def run(batches):
        for b in batches:
            for i, n, words in word_chunks(b.column(2)):
                low = anchors(words, words.hashes(), min_words, k)
                at = _runs(low)
                at = at[low[at] != 0]
                g, off = low[at], np.searchsorted(at, words.first)
                rows = np.flatnonzero(words.counts >= min_words)
                take = pa.array(rows + i)
                lists = [np.unique(g[off[r] : off[r + 1]]).view(np.int64) for r in rows]
                size = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
                flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
                yield pa.record_batch([b.column(0).take(take), b.column(1).take(take), pa.array(words.counts[rows].astype(np.int64)), pa.ListArray.from_arrays(pa.array(size), pa.array(flat))], ["d", "t", "n", "fps"])
        release()

    return run


def _windows(min_words: int, k: int):
    """(h, g, d, t, p) of each window that may repeat, at word p; h, g: its hash."""

    def run(batches):
        for b in batches:
            d, t = b.column(0).to_numpy(), b.column(1).to_numpy()
            for i, n, words in word_chunks(b.column(2)):
                h = words.hashes()
                low = anchors(words, h, min_words, k)
                at = _runs(low)
                row = np.searchsorted(words.first, at, side="right") - 1
                known = [np.asarray(x, np.int64) for x in b.column(3)[i : i + n].to_numpy(zero_copy_only=False)]
                keys = np.concatenate([mix64(x.view(np.uint64) + np.uint64(r)) for r, x in enumerate(known)]) if known else np.zeros(0, np.uint64)
                shared = (low[at] != 0) & np.isin(mix64(low[at] + row.astype(np.uint64)), keys)
                ok = np.flatnonzero(np.repeat(shared, np.diff(np.append(at, len(low)))))
                if not len(ok):
                    continue
                one, two = grams(h, min_words)[ok], grams(h * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(9), min_words)[ok]
                r = np.searchsorted(words.first, ok, side="right") - 1
                p = (ok - words.first[r]).astype(np.int32)
                for a in range(0, len(ok), 50_000):
                    z = slice(a, a + 50_000)
                    yield pa.record_batch([pa.array(one[z].view(np.int64)), pa.array((two[z] >> np.uint64(32)).astype(np.uint32).view(np.int32)), pa.array(d[i + r[z]]), pa.array(t[i + r[z]]), pa.array(p[z])], ["h", "g", "d", "t", "p"])
        release()

    return run


def _compress(batches):
    """Runs (d, t, p, n, rd, rt, rp, lo, hi, q) of rows (d, t, p, rd, rt, rp) in order of d, t, p.

    n windows from p on have their first places from rp on in document (rd, rt), and from rp on again after each q of
    them if q isn't 0, as where a text repeats q words; lo, hi: the stretch of such windows, at places of other
    documents, that the run is part of.
    """
    names = ["d", "t", "p", "n", "rd", "rt", "rp", "lo", "hi", "q"]
    held: list[np.ndarray] = []  # runs of the document in hand

    def flush(runs: np.ndarray):
        d, t, p, n, rd, rt, _ = runs
        foreign = (rd != d) | (rt != t)
        new = np.concatenate(([True], (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (p[1:] != p[:-1] + n[:-1]) | (foreign[1:] != foreign[:-1])))
        of, start = np.cumsum(new) - 1, np.flatnonzero(new)
        last = np.append(start[1:], len(p)) - 1
        lo, hi = p[start][of], (p + n)[last][of]
        again = np.concatenate(([False], ~new[1:] & (runs[4:, 1:] == runs[4:, :-1]).all(0)))
        fewer = again & np.concatenate(([False], n[1:] < n[:-1]))  # the last of a cycle may be cut short
        again &= np.concatenate(([False], n[1:] <= n[:-1]))
        again[1:] &= ~fewer[:-1]
        at = np.flatnonzero(~again)
        size = np.diff(np.append(at, len(p)))
        whole = np.add.reduceat(n, at) if len(at) else n
        return pa.record_batch([pa.array(x) for x in (d[at], t[at], p[at], whole, *runs[4:, at], lo[at], hi[at], np.where(size > 1, n[at], 0))], names)

    for b in batches:
        x = np.stack([b.column(k).to_numpy().astype(np.int64) for k in range(6)])
        if not x.shape[1]:
            continue
        same = (x[:, 1:] == x[:, :-1]).all(0)
        x = x[:, np.concatenate(([True], ~same))]  # rows equal in id and text are one document
        d, t, p, rd, rt, rp = x
        new = np.concatenate(([True], (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (p[1:] != p[:-1] + 1) | (rd[1:] != rd[:-1]) | (rt[1:] != rt[:-1]) | (rp[1:] != rp[:-1] + 1)))
        at = np.flatnonzero(new)
        n = np.diff(np.append(at, len(p)))
        runs = np.stack((d[at], t[at], p[at], n, rd[at], rt[at], rp[at]))
        if held:
            old = held[-1]
            e = old[:, -1]
            f = runs[:, 0]
            if (e[[0, 1, 4, 5]] == f[[0, 1, 4, 5]]).all() and e[2] - e[6] == f[2] - f[6] and f[2] <= e[2] + e[3]:
                old[3, -1] = f[2] + f[3] - e[2]
                runs = runs[:, 1:]
            held.append(runs)
            runs = np.concatenate(held, 1)
        end = np.flatnonzero((runs[0] != runs[0, -1]) | (runs[1] != runs[1, -1]))
        cut = int(end[-1]) + 1 if len(end) else 0
        if cut:
            yield flush(runs[:, :cut])
        held = [runs[:, cut:]]
    if held and held[0].shape[1]:
        yield flush(held[0])


def _passages(batches):
    """(key, d, t, p, left, off, last, lo, hi, cycle) for each passage of a document through some of its runs.

    p: last window of the run that it comes from; left: windows of that run; off: from p to the run it ends in;
    last: windows of that; lo, hi: the stretch of windows at places of other documents that it lies in, or -1, and then
    the passage is only one that others may share. A document's own first places are runs too. Keys are
    hashes of 64 bits of all runs passed; a passage is the same if its runs are. A run that goes in a cycle has rows
    of its own too, for lengths of STEPS that it reaches; cycle is its length, and 0 elsewhere.
    """
    names = ["key", "d", "t", "p", "left", "off", "last", "lo", "hi", "cycle"]
    for b in batches:
        out = []
        for d, t, own in zip(*[b.column(k).to_pylist() for k in range(3)]):
            runs, at = [], 0
            for r in sorted((r["p"], r["n"], r["rd"], r["rt"], r["rp"], r["lo"] if (r["rd"], r["rt"]) != (d, t) else -1, r["hi"], r["q"]) for r in own):
                if r[0] > at:
                    runs.append((at, r[0] - at, d, t, at, -1, -1, 0))
                runs.append(r)
                at = r[0] + r[1]
            runs.append((at, 1 << 40, d, t, at, -1, -1, 0))  # what comes after, if anything does
            p, n, rd, rt, rp, lo, hi, q = np.array(runs, np.int64).T
            for c in np.flatnonzero(q):
                more = q[c] if (rd[c], rt[c], rp[c] + q[c]) == (d, t, p[c]) else 0  # its first round is the first place itself
                k = np.array([m for m in STEPS if m <= n[c] + more], np.int64)
                key = mix64(mix64(mix64(mix64(rd[c : c + 1].view(np.uint64)) + rt[c : c + 1].view(np.uint64)) + rp[c : c + 1].view(np.uint64)) + q[c : c + 1].view(np.uint64) + np.uint64(1 << 40) * k.astype(np.uint64))
                full = lambda v: np.full(len(k), v)
                out.append(np.stack((key.view(np.int64), full(d), full(t), full(p[c] - 1 - more), full(0), full(1), full(n[c] + more), full(lo[c]), full(hi[c] if lo[c] >= 0 else -1), full(n[c] + more))))
            if len(p) < 2:
                continue
            place = lambda i, q: mix64(mix64(mix64(rd[i].view(np.uint64)) + rt[i].view(np.uint64)) + q.view(np.uint64))
            i = np.arange(len(p) - 1)
            at, end = np.concatenate((p[1:], [0]))[:-1], p + n - 1  # a passage is from end[i] to at[i]
            powers = [mix64(place(i, rp[i] + np.where(q[i] > 0, (n[i] - 1) % np.maximum(q[i], 1), n[i] - 1)) + np.uint64(3) * place(i + 1, rp[i + 1]))]
            for m in STEPS:
                if m > len(i):
                    break
                j = m.bit_length() - 1
                while len(powers) <= j:
                    half, h = powers[-1], 1 << (len(powers) - 1)
                    powers.append(mix64(half[:-h] + mix64(half[h:] + (end[h : h + len(half) - h] - end[: len(half) - h]).astype(np.uint64))))
                k = i[: len(i) - m + 1]
                span = (p[k + m] - end[k]).astype(np.uint64)
                key = mix64(powers[j][k] + mix64(powers[j][k + m - (1 << j)] + span) + np.uint64(m))
                inside = (lo[k] >= 0) & (lo[k] == lo[k + m])
                out.append(np.stack((key.view(np.int64), np.full(len(k), d), np.full(len(k), t), end[k], n[k], p[k + m] - end[k], n[k + m], np.where(inside, lo[k], -1), np.where(inside, hi[k], -1), np.zeros(len(k), np.int64))))
        if out:
            x = np.concatenate(out, 1)
            for a in range(0, x.shape[1], 50_000):
                yield pa.record_batch([pa.array(c) for c in x[:, a : a + 50_000]], names)


def parse(found: list[tuple]) -> list[tuple[int, int, int]]:
    """Greedy factors (first window, end window, id of the source) of one document.

    found: its matches (lo, hi, delta, place, a, z, once): windows a to z of the stretch from lo to hi are delta windows
    further on in the document `place`, or, if once is less than z, as far as that, and in cycles the rest.
    Of several longest matches that of the first document counts. Factors of a cycle in one source are given as one.
    """
    factors: list[tuple[int, int, int]] = []
    stretches: dict[tuple[int, int], dict] = {}
    cycles: dict[tuple[int, int], list] = {}
    for lo, hi, delta, place, a, z, once in found:
        if once < z:
            cycles.setdefault((lo, hi), []).append((a, z, place, once - a))
            stretches.setdefault((lo, hi), {})
        else:
            stretches.setdefault((lo, hi), {}).setdefault((place, delta), []).append((a, z))
    for (lo, hi), by in sorted(stretches.items()):
        whole = []
        for (place, delta), parts in by.items():  # what touches or overlaps in one document is one match
            parts.sort()
            a, z = parts[0]
            for x, y in parts[1:]:
                if x <= z:
                    z = max(z, y)
                else:
                    whole.append((a, z, place, delta))
                    a, z = x, y
            whole.append((a, z, place, delta))
        whole.sort()
        round_ = sorted(cycles.get((lo, hi), []))
        p, k, c, best, going = lo, 0, 0, None, []
        while p < hi:
            while k < len(whole) and whole[k][0] <= p:
                f = whole[k]
                if best is None or (-f[1], f[2], f[3]) < (-best[1], best[2], best[3]):
                    best = f
                k += 1
            while c < len(round_) and round_[c][0] <= p:
                going.append(round_[c])
                c += 1
            going = [g for g in going if g[1] > p]
            options = [(-(p + g[3]), g[2], g[1]) for g in going]
            if best is not None and best[1] > p:
                options.append((-best[1], best[2], best[1]))
            _, place, end = min(options)
            factors.append((p, end, place[0]))
            p = end
    return factors


def spans_of(factors: list[tuple[int, int, int]], min_words: int) -> list[tuple[int, int, list[int]]]:
    """Duplicate spans (start, end, reference ids): factors that touch make one, with their references in order."""
    spans: list[tuple[int, int, list[int]]] = []
    for a, z, ref in factors:
        start, end = a, z - 1 + min_words
        if spans and start <= spans[-1][1]:
            s, e, refs = spans[-1]
            spans[-1] = (s, max(e, end), refs if ref in refs else [*refs, ref])
        else:
            spans.append((start, end, [ref]))
    return spans


def _parse(min_words: int):
    """Spans of rows (d, t, lo, hi, delta, rd, rt, a, z, once) in order of d, t; a document at a time."""

    def run(batches):
        held, key, rows = [], None, []
        for b in batches:
            d, t = b.column(0).to_numpy(), b.column(1).to_numpy()
            new = np.flatnonzero((d[1:] != d[:-1]) | (t[1:] != t[:-1])) + 1
            cut = [0, *new.tolist(), len(d)]
            rest = [b.column(k).to_pylist() for k in range(2, 10)]
            for s, e in zip(cut[:-1], cut[1:]):
                if s == e:
                    continue
                if key != (d[s], t[s]):
                    if held:
                        rows += [(int(key[0]), *x) for x in spans_of(parse(held), min_words)]
                    held, key = [], (d[s], t[s])
                held += [(lo, hi, delta, (rd, rt), a, z, once) for lo, hi, delta, rd, rt, a, z, once in zip(*[c[s:e] for c in rest])]
            if len(rows) >= 5000:
                yield _span_rows(rows)
                rows = []
        if held:
            rows += [(int(key[0]), *x) for x in spans_of(parse(held), min_words)]
        if rows:
            yield _span_rows(rows)
        release()

    return run


def _span_rows(rows: list[tuple]) -> pa.RecordBatch:
    c = list(zip(*rows))
    return pa.record_batch([pa.array(c[0], pa.int64()), pa.array(c[1], pa.int32()), pa.array(c[2], pa.int32()), pa.array(c[3], pa.list_(pa.int64()))], ["d", "start_word", "end_word", "refs"])


def duplicate_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, start_word, end_word, ref_doc_ids): spans of words that earlier documents have.

    Words are what stands between ASCII white space; end_word is exclusive. Documents
    are ordered by (doc_id, text hash); a repeat inside one document alone is none. A
    span is the union of factors of min_words words or more that touch, and names their
    documents in order. Null and shorter texts have no spans. Rows equal in id and text are
    one document. A null id comes before all others and is null in the result. An empty
    table gives no rows; extra columns are ignored.

    Factors are the longest matches among those that are looked up. A document that passes through more runs
    in a row than any other, but through each number of STEPS of them as a later one, is missed; the span is the same.
    """
    k = max(1, min(ANCHOR, min_words // 2))
    texts = docs.where("text is not null").select(*key_columns(), "text")
    marked = texts.mapInArrow(_anchor_rows(min_words, k), "d bigint, t bigint, n bigint, fps array<bigint>")
    first = durable(marked.groupBy("t").agg(F.min("d").alias("d"), F.first("n").alias("n"), F.first("fps").alias("fps")))
    copies = texts.select("d", "t").distinct().join(first.select("t", F.col("d").alias("fd"), "n"), "t").where("d != fd")
    copies = copies.select("d", F.lit(0).alias("start_word"), F.col("n").cast("int").alias("end_word"), F.array("fd").alias("refs"))
    rows = first.select("d", "t", F.explode("fps").alias("fp"))
    shared = rows.groupBy("fp").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).where("lo != hi").select("fp")
    mine = rows.join(shared, "fp").groupBy("d", "t").agg(F.collect_list("fp").alias("fps"))
    windows = texts.join(mine, ["d", "t"]).select("d", "t", "text", "fps").mapInArrow(_windows(min_words, k), "h bigint, g int, d bigint, t bigint, p int")
    place = F.first(F.struct("d", "t", "p")).over(Window.partitionBy("h", "g").orderBy("d", "t", "p"))
    named = windows.withColumn("f", place).where(F.struct("d", "t", "p") != F.col("f")).select("d", "t", "p", F.col("f.d").alias("rd"), F.col("f.t").alias("rt"), F.col("f.p").alias("rp"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = named.repartition(n, "d", "t").sortWithinPartitions("d", "t", "p")
    runs = ordered.mapInArrow(_compress, ", ".join(f"{c} bigint" for c in ("d", "t", "p", "n", "rd", "rt", "rp", "lo", "hi", "q")))
    own = durable(runs.groupBy("d", "t").agg(F.collect_list(F.struct("p", "n", "rd", "rt", "rp", "lo", "hi", "q")).alias("own")))
    run = F.col("run")
    at_place = own.select("d", "t", F.explode("own").alias("run")).select("d", "t", run.lo.alias("lo"), run.hi.alias("hi"), (run.rp - run.p).alias("delta"), run.rd.alias("rd"), run.rt.alias("rt"), run.p.alias("a"), (run.p + run.n).alias("z"), (run.p + F.when(run.q > 0, run.q).otherwise(run.n)).alias("once"))
    passages = durable(own.mapInArrow(_passages, ", ".join(f"{c} bigint" for c in ("key", "d", "t", "p", "left", "off", "last", "lo", "hi", "cycle"))))
    pioneers = passages.groupBy("key").agg(F.min(F.struct("d", "t", "p", "left", "last")).alias("f"), F.count("*").alias("c")).where("c > 1").select("key", "f")
    f, p = F.col("f"), F.col("p")
    once = p + F.col("off") + F.least("last", f["last"])
    passed = passages.where("lo >= 0").join(pioneers, "key").select("d", "t", "lo", "hi", (f.p - p).alias("delta"), f.d.alias("rd"), f.t.alias("rt"), (p + 1 - F.least("left", f.left)).alias("a"), F.when(F.col("cycle") > 0, p + 1 + F.col("cycle")).otherwise(once).alias("z"), once.alias("once"))
    found = at_place.unionByName(passed).where("rd < d or rd = d and rt < t").repartition(n, "d", "t").sortWithinPartitions("d", "t")
    spans = found.mapInArrow(_parse(min_words), "d bigint, start_word int, end_word int, refs array<bigint>")
    null = lambda c: F.when(c != NO_ID, c)
    return spans.union(copies).select(null(F.col("d")).alias("doc_id"), "start_word", "end_word", F.transform("refs", null).alias("ref_doc_ids"))
