"""SentencePiece encoding and decoding: streaming Viterbi.

The lattice of pieces over a text is walked left to right, a character at a time. Each
position keeps one backpointer: for a unigram model to the best-scoring predecessor, for a
BPE model to the one piece that can follow the encoding of the text before it (a piece b can
follow a if encoding a+b gives [a, b] again; so the path is exactly what merging gives).
Only positions within the longest piece's length of the front can be extended; once the paths
from all of them pass through one boundary, the ids before it are committed and their
backpointers given up.

White space starts pieces and never ends one, so every surviving path passes through every
word start: a text is committed there at the latest, and what stands between two word starts,
a unit, is a stream of its own. The streams of a batch run side by side, one character of all of
them in a step; equal ones in a batch run once. Nothing is kept from batch to batch but a table of
fixed size, of pairs of pieces that are known to follow each other or not.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _powers, mix64, release

#: Production parameter: the vocabulary file of a public tokenizer.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Characters encoded at a time; a longer text is cut at a word start.
CHUNK = 1 << 20
#: Slots of the table of pairs: 9 bytes each.
PAIRS = 1 << 20
NONE = np.uint16(0xFFFF)
_B = np.uint64(0x9E3779B97F4A7C15 | 1)


class HashTable:
    """An immutable map from 64-bit keys (not 0) to int32, looked up by arrays."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = max(10, int(np.ceil(np.log2(len(keys) + 1))) + 2)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        left, at = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[at] == 0
            new, first = np.unique(at[free], return_index=True)
            chosen = np.flatnonzero(free)[first]
            self.keys[new], self.values[new] = keys[left[chosen]], values[left[chosen]]
            rest = np.ones(len(left), bool)
            rest[chosen] = False
            left, at = left[rest], (at[rest] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0xD6E8FEB86659FD93)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, -1 where there is none."""
        at = self._slot(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.values[at], np.int32(-1))
        left = np.flatnonzero((there != keys) & (there != 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            there = self.keys[at[left]]
            hit = there == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (there != 0)]
        return out


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices starts[0], starts[0] + 1, ... of ranges laid end to end."""
    total = np.cumsum(sizes)
    return np.repeat(starts - (total - sizes), sizes) + np.arange(total[-1] if len(total) else 0)


class Vocabulary:
    """Pieces, scores and byte pieces of a model file; rank orders BPE merges."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = pb.ModelProto()
        proto.ParseFromString(sp.serialized_model_proto())
        size = sp.get_piece_size()
        self.unk = sp.unk_id()
        self.piece = [sp.id_to_piece(i) for i in range(size)]
        self.bpe = proto.trainer_spec.model_type == pb.TrainerSpec.BPE
        self.dummy_prefix = proto.normalizer_spec.add_dummy_prefix
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(size)]
        self.ids = {p: i for i, p in enumerate(self.piece) if not special[i]}
        self.score = np.array([sp.get_score(i) for i in range(size)])
        self.worst = self.score.min() - 10
        self.rank = np.array([-1.0 if len(p) == 1 else -s for p, s in zip(self.piece, self.score)])
        self.byte_id = {int(self.piece[i][3:5], 16): i for i in range(size) if sp.is_byte(i)}
        byte_of = {i: b for b, i in self.byte_id.items()}
        self.bytes = [bytes([byte_of[i]]) if i in byte_of else b"" if special[i] and i != self.unk else " ⁇ ".encode() if i == self.unk else p.replace(SPACE, " ").encode() for i, p in enumerate(self.piece)]
        self.longest = max(map(len, self.ids), default=1)
        self.words = all(SPACE not in p.lstrip(SPACE) for p in self.ids)
        self.newline_alone = "\n" not in "".join(self.ids)

    def merge(self, s: str) -> tuple[list[str], tuple[str, str] | None]:
        """BPE of a short string, by merging: (pieces, the last pair merged)."""
        parts, last = list(s), None
        while len(parts) > 1:
            best, at = np.inf, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and self.rank[i] < best:
                    best, at = self.rank[i], k
            if at < 0:
                break
            last = (parts[at], parts[at + 1])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts, last


class Encoder:
    """Encodes and decodes many texts at once."""

    def __init__(self, path: str = MODEL):
        self.v = v = Vocabulary(path)
        size = len(v.piece)
        if size >= NONE:
            raise ValueError(f"{path}: more than {NONE - 1} pieces")
        self.left, self.right = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        usable = v.ids
        if v.bpe:
            for p, i in v.ids.items():  # the two pieces that merge into each at last
                whole, last = v.merge(p)
                if len(whole) == 1 and last and last[0] in v.ids and last[1] in v.ids:
                    self.left[i], self.right[i] = v.ids[last[0]], v.ids[last[1]]
            usable = {p: i for p, i in v.ids.items() if len(p) == 1 or self.left[i] >= 0}
        heads = {p[:k]: -2 for p in usable for k in range(1, len(p))} | usable
        texts = list(heads)
        keys = np.zeros(len(texts), np.uint64)
        flat, n = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.uint64), np.array([len(t) for t in texts])
        first = np.cumsum(n) - n
        for k in range(int(n.max(initial=0))):
            on = np.flatnonzero(n > k)
            keys[on] = keys[on] * _B + flat[first[on] + k] + np.uint64(1)
        # Values: 2 * id of a piece + 2; odd ones more are heads of longer pieces only.
        self.heads = HashTable(keys, np.array([1 if i < 0 else 2 * i + 2 for i in heads.values()], np.int32))
        splits = [(v.ids[p[:k]] * size + v.ids[p[k:]] + 1, i) for p, i in v.ids.items() for k in range(1, len(p)) if p[:k] in v.ids and p[k:] in v.ids] if v.bpe else []
        self.merged = HashTable(np.array([a for a, _ in splits], np.uint64), np.array([i for _, i in splits], np.int32))
        self.known, self.known_says = np.zeros(PAIRS, np.uint64), np.zeros(PAIRS, bool)
        self.blob, self.blob_size = np.frombuffer(b"".join(v.bytes), np.uint8), np.array([len(b) for b in v.bytes])
        self.blob_at = np.cumsum(self.blob_size) - self.blob_size

    def follows(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether pieces a, b stay apart when a+b is encoded, pair by pair; remembered in a table of PAIRS slots."""
        key = a.astype(np.uint64) * np.uint64(len(self.v.piece)) + b.astype(np.uint64) + np.uint64(1)
        slot = (mix64(key) & np.uint64(PAIRS - 1)).astype(np.int64)
        out, miss = self.known_says[slot], np.flatnonzero(self.known[slot] != key)
        if len(miss):
            new, first, where = np.unique(key[miss], return_index=True, return_inverse=True)
            says = self._follows(a[miss[first]], b[miss[first]])
            out[miss] = says[where]
            at = slot[miss[first]]
            self.known[at], self.known_says[at] = new, says
            clash = self.known[at] != new  # two new pairs in one slot: the value must be that of the key that stands there
            if clash.any():
                self.known[at[clash]] = 0
        return out

    def _follows(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Undo the later of the last merges of x and y in turn, and see that the pair at the seam never came first."""
        rank, size = self.v.rank, np.uint64(len(self.v.piece))
        x, y = x.astype(np.int64), y.astype(np.int64)
        out, at, limit = np.ones(len(x), bool), np.arange(len(x)), np.full(len(x), np.inf)
        while len(at):
            c = self.merged.get(x.astype(np.uint64) * size + y.astype(np.uint64) + np.uint64(1))
            joined = (c >= 0) & (rank[c] < limit)
            left = rank[x] > rank[y]
            done = ~left & (rank[y] < 0)
            limit = np.where(left, rank[x], rank[y] + 0.5)
            x, y = np.where(left, self.right[x], x), np.where(left, y, self.left[y])
            lost = joined | (~done & ((x < 0) | (y < 0)))
            out[at[lost]] = False
            on = ~(lost | done)
            at, x, y, limit = at[on], x[on], y[on], limit[on]
        return out

    def pieces(self, buf: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """(longest, characters): at [L - 1, p] the piece of L characters that ends with character p of its unit, or NONE."""
        out = np.full((self.v.longest, len(buf)), NONE, np.uint16)
        room = np.repeat(first + size, size)
        at, h = np.arange(len(buf)), np.zeros(len(buf), np.uint64)
        for k in range(self.v.longest):
            h = h * _B + buf[at + k] + np.uint64(1)
            found = self.heads.get(h)
            on = np.flatnonzero(found > 0)
            found, at, h = found[on], at[on], h[on]
            piece = np.flatnonzero(found & 1 == 0)
            out[k, at[piece] + k] = (found[piece] >> 1) - 1
            on = at + (k + 1) < room[at]
            at, h = at[on], h[on]
        return out

    def streams(self, buf: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The committed pieces of units, longest unit first, that lie end to end in buf: at each character -1, or
        the id of the piece that ends there, or -2 for a character without a piece.

        Row e % depth of the rings holds of each unit the piece and its length that end at its position e, since
        its last commitment; depth is four times the longest piece, and more where paths don't meet for so long.
        """
        v, out = self.v, np.full(len(buf), -1, np.int32)
        piece_at, longest, lanes = self.pieces(buf, first, size), v.longest, len(first)
        if not lanes:
            return out
        depth = 4 * longest
        tok, back = np.full((depth, lanes), -1, np.int32), np.zeros((depth, lanes), np.int32)
        best = None if v.bpe else np.zeros((depth, lanes))
        done = np.zeros(lanes, np.int64)  # committed up to here
        live = np.searchsorted(-size, -np.arange(1, int(size[0]) + 2), side="right")  # units that have a character e
        for e in range(1, int(size[0]) + 1):
            n = int(live[e - 1])
            at = first[:n] + (e - 1)
            row = e % depth
            found, length = np.full(n, -2, np.int32), np.ones(n, np.int32)
            if v.bpe:
                open_ = np.ones(n, bool)
            else:
                value = best[(e - 1) % depth, :n] + v.worst
                some = np.zeros(n, bool)
            for k in range(min(longest, e), 0, -1):
                ids = piece_at[k - 1, at]
                hit = np.flatnonzero((ids != NONE) & open_ if v.bpe else ids != NONE)
                if not len(hit):
                    continue
                ids = ids[hit].astype(np.int32)
                if v.bpe:
                    a = tok[(e - k) % depth, hit]
                    ok = a < 0
                    ask = np.flatnonzero(~ok)
                    ok[ask] = self.follows(a[ask], ids[ask])
                    hit, ids = hit[ok], ids[ok]
                    open_[hit] = False
                else:
                    new = best[(e - k) % depth, hit] + v.score[ids]
                    ok = ~some[hit] | (new > value[hit])
                    hit, ids = hit[ok], ids[ok]
                    value[hit], some[hit] = new[ok], True
                found[hit], length[hit] = ids, k
            tok[row, :n], back[row, :n] = found, length
            if best is not None:
                best[row, :n] = value
            ends = int(live[e])
            if ends < n:  # the unit is over, and with it all paths but one
                self._commit(out, first, done, tok, back, np.arange(ends, n), np.full(n - ends, e))
            if e % longest == 0 and ends:
                lag = np.flatnonzero(e - done[:ends] >= 2 * longest)
                meet = self._meet(back, lag, e, done)
                self._commit(out, first, done, tok, back, lag, meet)
                if len(lag) and e + longest - int(done[:ends].min()) >= depth - 1:
                    rows = np.arange(e - depth + 1, e + 1)
                    new = rows % (2 * depth)
                    grow = lambda x: np.concatenate((x, x))
                    old, (tok, back, best) = (tok, back, best), (grow(tok), grow(back), None if best is None else grow(best))
                    for x, y in zip(old, (tok, back, best)):
                        if x is not None:
                            y[new] = x[rows % depth]
                    depth *= 2
        return out

    def _meet(self, back: np.ndarray, lanes: np.ndarray, e: int, done: np.ndarray) -> np.ndarray:
        """Of each lane the boundary that the paths from all its live positions pass through: the furthest steps back until all have met."""
        depth, w = len(back), self.v.longest
        if not len(lanes):
            return np.zeros(0, np.int64)
        ends = np.arange(e - w + 1, e + 1)[:, None].repeat(len(lanes), 1)
        on = np.arange(len(lanes))
        while len(on):
            sub = ends[:, on]
            far, near = sub.max(0), sub.min(0)
            apart = (far > near) & (near > done[lanes[on]])
            on, sub, far = on[apart], sub[:, apart], far[apart]
            if not len(on):
                break
            ends[:, on] = np.where(sub == far, far - back[far % depth, lanes[on]], sub)
        low = ends.min(0)
        return np.where(ends.max(0) == low, low, done[lanes])

    def _commit(self, out, first, done, tok, back, lanes, upto) -> None:
        """Write the pieces of each lane's path from `upto` to what is committed already."""
        depth, at, on = len(tok), upto.copy(), np.arange(len(lanes))
        while len(on := on[at[on] > done[lanes[on]]]):
            lane, p = lanes[on], at[on]
            out[first[lane] + p - 1] = tok[p % depth, lane]
            at[on] = p - back[p % depth, lane]
        done[lanes] = upto

    def _units(self, c: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where units begin: texts, runs of blanks, and line ends if no piece has one."""
        new = np.zeros(len(c), bool)
        new[starts] = True
        if self.v.words:
            blank = c == ord(SPACE)
            new[1:] |= blank[1:] & ~blank[:-1]
            if self.v.newline_alone:
                line = c == 10
                new |= line
                new[1:] |= line[:-1]
        return np.flatnonzero(new)

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids of each)."""
        parts = [p for t in texts for p in self._cut(t)]
        n_parts = np.array([len(self._cut(t)) if len(t) > CHUNK else bool(t) for t in texts], np.int64)
        ids, n = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        a = 0
        while a < len(parts):
            z, held = a, 0
            while z < len(parts) and (z == a or held + len(parts[z]) <= CHUNK):
                held += len(parts[z])
                z += 1
            i, k = self._encode_parts(parts[a:z])
            ids.append(i)
            n.append(k)
            a = z
        total = np.concatenate(([0], np.cumsum(np.concatenate(n))))
        ends = total[np.cumsum(n_parts)]
        return np.concatenate(ids), np.diff(np.concatenate(([0], ends)))

    def _cut(self, text: str) -> list[str]:
        """The text with its blanks as pieces have them, in parts of about CHUNK characters that begin at a word."""
        if not text:
            return []
        text = (SPACE if self.v.dummy_prefix else "") + text.replace(" ", SPACE)
        out, a = [], 0
        while len(text) - a > CHUNK and self.v.words:
            z = text.rfind(SPACE, a + 1, a + CHUNK)
            while z > a and text[z - 1] == SPACE:
                z -= 1
            if z <= a:
                z = text.find(SPACE, a + CHUNK)
                if z < 0:
                    break
                if text[z - 1] == SPACE:  # inside a run of blanks: go on behind it
                    while z < len(text) and text[z] == SPACE:
                        z += 1
                    z = text.find(SPACE, z)
                    if z < 0:
                        break
            out.append(text[a:z])
            a = z
        return [*out, text[a:]]

    def _encode_parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        c = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")
        size = np.array([len(p) for p in parts])
        starts = np.cumsum(size) - size
        at = self._units(c, starts)
        long = np.diff(np.append(at, len(c)))
        c = c.astype(np.uint64)
        up, down = _powers(len(c) + 1)
        h = []
        for x in (c + np.uint64(1), (c + np.uint64(77)) * (c * _B + np.uint64(5))):  # two hashes of each unit, of 64 bits
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * up[: len(c)])))
            h.append(mix64((total[at + long] - total[at]) * down[at] + long.astype(np.uint64)))
        _, rep, which = np.unique(h[0], return_index=True, return_inverse=True)
        if (h[1][rep][which] != h[1]).any():
            pairs = np.stack(h, 1)
            _, rep, which = np.unique(pairs, axis=0, return_index=True, return_inverse=True)
            which = which.ravel()
        order = np.argsort(-long[rep], kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        rep, which = rep[order], place[which]
        n = long[rep]
        first = np.cumsum(n) - n
        buf = c[ragged(at[rep], n)]
        found = self.streams(buf, first, n)
        ids, count = self._expand(buf, found)
        total = np.concatenate(([0], np.cumsum(count)))
        unit_at, unit_n = total[first], total[first + n] - total[first]
        flat = ids[ragged(unit_at[which], unit_n[which])]
        of_text = np.searchsorted(at, starts)
        ends = np.concatenate(([0], np.cumsum(unit_n[which])))
        return flat, np.diff(np.append(ends[of_text], ends[-1]))

    def _expand(self, buf: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids in order, number of ids at each character); a character without a piece is spelled by bytes."""
        count = (found != -1).astype(np.int64)
        odd = np.flatnonzero(found == -2)
        if not len(odd):
            return found[found >= 0], count
        chars, where = np.unique(buf[odd], return_inverse=True)
        byte_id = self.v.byte_id
        spelled = [[byte_id[b] for b in chr(int(x)).encode()] if len(byte_id) == 256 else [self.v.unk] for x in chars]
        n = np.array([len(s) for s in spelled])
        flat, first = np.array([i for s in spelled for i in s], np.int32), np.cumsum(n) - n
        count[odd] = n[where]
        ids = np.repeat(found, count)
        at = np.cumsum(count) - count
        ids[ragged(at[odd], n[where])] = flat[ragged(first[where], n[where])]
        return ids, count

    def decode_many(self, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(UTF-8 bytes of all texts end to end, number of bytes of each)."""
        size = self.blob_size[ids]
        data = self.blob[ragged(self.blob_at[ids], size)]
        total = np.concatenate(([0], np.cumsum(size)))
        ends = total[np.concatenate(([0], np.cumsum(n)))]
        if self.v.dummy_prefix:
            a = ends[:-1][ends[1:] > ends[:-1]]
            a = a[data[a] == 32]
            keep = np.ones(len(data), bool)
            keep[a] = False
            gone = np.concatenate(([0], np.cumsum(~keep)))
            data, ends = data[keep], ends - gone[ends]
        return data, np.diff(ends)

    def encode(self, text: str) -> list[int]:
        return self.encode_many([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        return self.decode_many(np.array(ids, np.int64), np.array([len(ids)]))[0].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker: about 25 MB, whatever it has encoded."""
    return Encoder(path)


def encode_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded): the ids of each text and what they decode to.

    Row by row, so repeated rows repeat and null ids stay. A null text has null ids and
    null decoded text and 0 tokens; an empty one has no ids and decodes to "". Decoding
    gives the text back, except that U+2581, which stands for a blank in pieces, comes back as
    a blank. Extra columns are ignored.
    """

    def run(batches):
        enc = encoder(model)
        for batch in batches:
            sizes = np.cumsum(pc.utf8_length(batch.column(1)).fill_null(0).to_numpy())
            a = 0
            while a < batch.num_rows:
                base = sizes[a - 1] if a else 0
                z = max(a + 1, int(np.searchsorted(sizes, base + CHUNK, side="right")))
                yield _encoded(enc, batch.slice(a, z - a))
                a = z
        release()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids array<int>, decoded string")


def _encoded(enc: Encoder, part: pa.RecordBatch) -> pa.RecordBatch:
    texts = part.column(1).to_pylist()
    valid = np.array([t is not None for t in texts], bool)
    ids, n = enc.encode_many([t or "" for t in texts])
    data, size = enc.decode_many(ids, n)
    offsets = lambda x: pa.array(np.concatenate(([0], np.cumsum(x))).astype(np.int32))
    lists = pa.ListArray.from_arrays(offsets(n), pa.array(ids.astype(np.int32)), mask=pa.array(~valid))
    bits = pa.array(valid).buffers()[1]
    decoded = pa.StringArray.from_buffers(len(texts), offsets(size).buffers()[1], pa.py_buffer(data), bits)
    return pa.record_batch([part.column(0), pa.array(n, pa.int64()), lists, decoded], ["doc_id", "n_tokens", "ids", "decoded"])
