"""Mixing sources to target weights: soft-membership mixing.

A softmax classifier, fitted on the labelled table, gives each document a posterior over
domains. Document rates r (expected copies) then solve the least squares problem

    min 1/2 sum_d ((t_d(r) - T_d) / T_d)^2,   t_d(r) = sum_i r_i n_i p_id,   l_i <= r_i <= MAX_RATE

by projected gradient, with n_i the words of document i, p_i its posterior and T the target
words of each domain. l_i is 1 for a document that the classifier finds of the anchor's domain,
with at least half of the posterior, and 0 for others: so no document of the anchor is lost, and none is
repeated more than MAX_RATE times. A target can't be reached beyond what its domain has with all other documents
at MAX_RATE and those of the anchor as they are, nor below what those of the anchor have alone. It is then moved to that
bound (Rates.reachable), so that the mix doesn't fill up with documents of the anchor for the traces of a domain they hold.

The gradient of a document, per word, depends on its posterior alone. Posteriors are put into cells,
CELLS levels of each rarer domain by the logarithm, and a cell has one rate. Words and expected words
by domain are summed over all documents, cell by cell, in one distributed aggregation with partial
sums; the iterations go over its at most (CELLS + 1)^2 sums, however large the corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import FEATURE_BITS, durable, fit_softmax, hashed_features, key_columns, labelled_sample, release, softmax_scores, unused, word_chunks

DOMAINS = ("good", "low", "toxic")
#: Production targets: shares of the mix, which is sized so that the anchor keeps its words.
TARGETS = {"good": 0.97, "low": 0.02, "toxic": 0.01}
ANCHOR = "good"
#: No document is in the mix more often than that.
MAX_RATE = 4.0
#: Bound of the labelled rows that the classifier is fitted on.
FIT_ROWS = 12_000
#: Levels of a posterior, eight for each halving, down to the millionth that posteriors are rounded to.
CELLS = 160
STEPS, TOLERANCE = 20_000, 1e-7


class DomainClassifier:
    """Posterior over DOMAINS from hashed word heads and tails.

    Fitted on at most `fit_rows` labelled documents; without any it gives equal
    probabilities. An empty text gets the prior.
    """

    def __init__(self, docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS):
        def features(batches):
            for batch in batches:
                for i, n, words in word_chunks(batch.column(1)):
                    off, idx = hashed_features(words)
                    take = slice(i, i + n)
                    yield pa.record_batch([batch.column(0)[take], batch.column(2)[take], batch.column(3)[take], pa.array([idx[a:b].astype("<i4").tobytes() for a, b in zip(off[:-1], off[1:])], pa.binary())], ["doc_id", "quality", "toxic", "f"])

        rows = labelled_sample(docs, labels, fit_rows).select("doc_id", "text", "quality", "toxic").mapInArrow(features, "doc_id bigint, quality int, toxic int, f binary").toArrow().sort_by("doc_id")
        q, t = rows.column("quality").to_numpy(), rows.column("toxic").to_numpy()
        kind = np.where(t == 1, 2, np.where(q == 0, 1, 0))
        f = [np.frombuffer(x, "<i4") for x in rows.column("f").to_pylist()]
        off = np.concatenate(([0], np.cumsum([len(x) for x in f]))).astype(np.int64)
        self.w, self.bias = fit_softmax(off, np.concatenate(f) if f else np.zeros(0, np.int32), np.eye(len(DOMAINS))[kind], 1 << FEATURE_BITS)

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(words, posteriors) of each text."""
        n, p = [np.zeros(0, np.int64)], [np.zeros((0, len(DOMAINS)))]
        for _, _, words in word_chunks(texts):
            n.append(words.counts)
            p.append(np.round(softmax_scores(words, self.w, self.bias), 6))
        return np.concatenate(n), np.concatenate(p)


def cells(p: np.ndarray, anchor: int = DOMAINS.index(ANCHOR)) -> np.ndarray:
    """The cell of each posterior: a level for each domain but the anchor's, and whether the anchor has half."""
    out = (p[:, anchor] >= 0.5).astype(np.int64)
    for k in range(p.shape[1]):
        if k != anchor:
            level = np.clip(np.round(-8 * np.log2(np.maximum(p[:, k], 2.0**-20))), 0, CELLS).astype(np.int64)
            out = out * (CELLS + 1) + level
    return out


def posteriors(docs: DataFrame, model: DomainClassifier) -> DataFrame:
    """(d, t, null_id, n, p, cell): words, posterior and cell of each row of docs."""

    def run(batches):
        for b in batches:
            n, p = model.score(b.column(3))
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(n.astype(np.int64)), pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), len(DOMAINS)).cast(pa.list_(pa.float64())), pa.array(cells(p))], ["d", "t", "null_id", "n", "p", "cell"])
        release()

    return docs.select(*key_columns(), F.col("doc_id").isNull().alias("null_id"), "text").mapInArrow(run, "d bigint, t bigint, null_id boolean, n bigint, p array<double>, cell bigint")


class Rates:
    """The rate of each cell that has documents; by domain, the words of the mix, those asked for, and the nearest that can be reached."""

    def __init__(self, cell: np.ndarray, rate: np.ndarray, words: np.ndarray, want: np.ndarray, reachable: np.ndarray):
        self.cell, self.rate, self.words, self.want, self.reachable = cell, rate, words, want, reachable

    def of(self, cell: np.ndarray) -> np.ndarray:
        if not len(self.cell):
            return np.ones(len(cell))
        return self.rate[np.searchsorted(self.cell, cell)]


def project(mass: np.ndarray, low: np.ndarray, want: np.ndarray, most: float, steps: int = STEPS) -> np.ndarray:
    """Rates in [low, most] for rows of mass (words by domain) that bring the sums nearest to `want`, by relative error.

    Projected gradient with momentum, which starts anew when it leads uphill. A rate's gradient is
    divided by its words, so that step lengths suit small and large rows alike.
    """
    n = np.maximum(mass.sum(1), 1e-12)
    p = mass / n[:, None]
    scaled = p / np.maximum(want, 1e-9)  # gradient of a rate, per word, for an error of 1 in each domain
    hessian = (scaled * n[:, None]).T @ scaled
    step = 1 / max(np.linalg.eigvalsh(hessian)[-1], 1e-30)
    error = lambda r: (r @ mass - want) / np.maximum(want, 1e-9)
    r = y = np.clip(np.ones(len(n)), low, most)
    e, momentum = error(r), 1.0
    for _ in range(steps):
        new = np.clip(y - step * (scaled @ error(y)), low, most)
        ne = error(new)
        if ne @ ne > e @ e * (1 + 1e-12):
            if y is r:
                break
            y, momentum = r, 1.0
            continue
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        moved = np.abs(new - r).max(initial=0)
        y = new + (momentum - 1) / after * (new - r)
        r, e, momentum = new, ne, after
        if np.abs(e).max() < TOLERANCE or moved < 1e-9:
            break
    return r


def fit_rates(scored: DataFrame, targets: dict[str, float] = TARGETS, anchor: str = ANCHOR, most: float = MAX_RATE) -> Rates:
    """Rates that bring each domain's words nearest to its share of a mix in which the anchor keeps its words."""
    D = len(DOMAINS)
    n = F.col("n")
    # Decimals, so that sums don't depend on the order of tasks.
    rows = scored.groupBy("cell").agg(F.sum(n).alias("n"), *[F.sum((n * F.col("p")[k]).cast("decimal(28,6)")).alias(f"m{k}") for k in range(D)]).collect()
    rows.sort(key=lambda r: r["cell"])
    mass = np.array([[float(r[f"m{k}"]) for k in range(D)] for r in rows]).reshape(-1, D)
    cell = np.array([r["cell"] for r in rows], np.int64)
    total = mass.sum(0)
    a = DOMAINS.index(anchor)
    want = np.array([targets[d] for d in DOMAINS])
    want = want / want[a] * total[a]
    if not total.sum() or not total[a]:
        return Rates(cell, np.ones(len(cell)), total, total, total)
    low = (cell >= (CELLS + 1) ** (D - 1)).astype(float)
    reachable = np.clip(want, low @ mass, np.where(low > 0, 1.0, most) @ mass)
    rate = project(mass, low, reachable, most)
    return Rates(cell, rate, rate @ mass, want, reachable)


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """(doc_id, n_words, p_good, p_low, p_toxic, rate) of every row of docs.

    Null and empty texts have 0 words, the prior as posterior, and that posterior's
    rate. Rows equal in all are rated alike, as are posteriors of one cell. Null ids stay null. Without
    words of the anchor all rates are 1. An empty table gives no rows; extra columns are ignored.
    """
    scored = durable(posteriors(docs, DomainClassifier(docs, labels)))
    rates = fit_rates(scored, targets)
    names = ["doc_id", "n_words", *[f"p_{d}" for d in DOMAINS], "cell"]

    def run(batches):
        for b in batches:
            yield pa.record_batch([*b.columns[:-1], pa.array(np.round(rates.of(b.column(len(names) - 1).to_numpy()), 4))], [*names[:-1], "rate"])

    rows = scored.select(F.when(~F.col("null_id"), F.col("d")), "n", *[F.col("p")[k] for k in range(len(DOMAINS))], "cell").toDF(*names)
    return rows.mapInArrow(run, f"doc_id bigint, n_words bigint, {', '.join(f'p_{d} double' for d in DOMAINS)}, rate double")


def resample(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """Documents repeated floor(rate + u) times, u a uniform hash of (doc_id, text): the mix itself.

    Rows with null and empty texts are repeated by the prior's rate; repeated rows are treated alike. All
    columns as they are, under any name. Posteriors are computed again rather than joined, so that
    no text is shuffled. An empty table gives an empty one.
    """
    model = DomainClassifier(docs, labels)
    rates = fit_rates(durable(posteriors(docs, model)), targets)

    @F.pandas_udf("double")
    def rate(texts):
        import pandas as pd

        return pd.Series(rates.of(cells(model.score(pa.Array.from_pandas(texts, type=pa.large_string()))[1])))

    d, t = key_columns()
    u = F.pmod(F.xxhash64(d, t, F.lit("mix")), F.lit(1 << 20)) / float(1 << 20)
    copy = unused(docs.columns, "__copy")
    rows = docs.withColumn(copy, F.floor(rate("text") + u).cast("int"))
    rows = rows.withColumn(copy, F.explode(F.sequence(F.lit(0), copy))).where(F.col(copy) > 0)
    return rows.select(*[f"`{c}`" for c in docs.columns])
