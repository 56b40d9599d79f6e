"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature is cut into bins by training quantiles. Boosting goes round the
features: each step fits one shallow tree (a few cuts of one feature's bins)
to the current logistic residuals and adds a fraction of its leaf values to
that feature's lookup table. Then the pairs of features whose coarse grid
still explains most of the residuals get tables of their own, boosted the
same way with one cut on either side. A score is the logistic of an
intercept plus one table entry per feature and pair, so scoring is a handful
of vectorised lookups.

Features are measured in Spark tasks; the fit itself sees at most
``MAX_TRAIN`` labelled rows of numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlake.llm.common import widened

#: Labelled rows the model is fit on: those with the smallest hash of doc_id.
MAX_TRAIN = 20_000
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, RATE, CUTS, SMOOTH = 150, 0.1, 3, 1.0
ROWS = 1024

FEATURES = (
    "log_bytes", "upper", "digit", "blank", "newline", "non_ascii", "bang", "symbol", "pipe", "other_punct",
    "word_len", "long_word", "distinct_words", "top_word", "marked_words", "line_len", "distinct_lines", "stops",
)

# -- features -------------------------------------------------------------------

_KIND = np.full(256, 9, np.uint8)
for _kind, _bytes in enumerate((
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\x0b\x0c", b"\n", b"!",
    b"#$%&*@^~+=<>\\`", b"|", b".,;:'\"()[]{}-_/?",
)):
    _KIND[list(_bytes)] = _kind


def features(text: str | None) -> list[float]:
    """The numbers of FEATURES for one whole text (a null text counts as empty)."""
    raw = (text or "").encode()
    n = max(len(raw), 1)
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=10)
    letters = max(int(kinds[0] + kinds[1] + kinds[9]), 1)
    words = raw.split()
    k = max(len(words), 1)
    count: dict[bytes, int] = {}
    for w in words:
        count[w] = count.get(w, 0) + 1
    lines = raw.split(b"\n")
    marked = sum(c for w, c in count.items() if w[-1] in b"!#$%&*@|")
    return [
        np.log1p(len(raw)), kinds[0] / letters, kinds[2] / n, kinds[3] / n, kinds[4] / n, kinds[9] / n, kinds[5] / n,
        kinds[6] / n, kinds[7] / n, kinds[8] / n, sum(len(w) * c for w, c in count.items()) / k,
        sum(c for w, c in count.items() if len(w) > 20) / k, len(count) / k, max(count.values(), default=0) / k,
        marked / k, np.log1p(len(raw) / len(lines)), len(set(lines)) / len(lines), raw.count(b". ") / k,
    ]


def feature_rows(batch: pa.RecordBatch, at: int) -> np.ndarray:
    return np.array([features(t) for t in batch.column(at).to_pylist()], float).reshape(-1, len(FEATURES))


# -- the model ------------------------------------------------------------------


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables; ``score`` adds them up."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    intercept: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], "right")]
        for f, g, table in self.pairs:
            total += table[
                np.searchsorted(self.coarse[f], x[:, f], "right"), np.searchsorted(self.coarse[g], x[:, g], "right")
            ]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SMOOTH)


def _tree(g: np.ndarray, h: np.ndarray, cuts: int) -> np.ndarray:
    """Leaf value per bin of a tree with at most ``cuts`` cuts, each the best
    one of all leaves; ``g`` and ``h``: the bins' gradient and curvature sums."""
    leaves = [(0, len(g))]
    for _ in range(cuts):
        best = None
        for k, (a, b) in enumerate(leaves):
            if b - a > 1:
                lg, lh = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
                tg, th = g[a:b].sum(), h[a:b].sum()
                gains = _gain(lg, lh) + _gain(tg - lg, th - lh) - _gain(tg, th)
                i = int(np.argmax(gains))
                if gains[i] > 1e-9 and (best is None or gains[i] > best[0]):
                    best = gains[i], k, a + i + 1
        if best is None:
            break
        a, b = leaves.pop(best[1])
        leaves += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in leaves:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + SMOOTH)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """The best one cut per side of a pair's grid: its gain and leaf values."""
    cg = np.pad(g.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    ch = np.pad(h.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    n, m = g.shape
    best = (0.0, np.zeros_like(g))
    for i in range(1, n):
        for j in range(1, m):
            out, gain = np.zeros_like(g), -_gain(cg[n, m], ch[n, m])
            for a, b in ((0, i), (i, n)):
                for c, d in ((0, j), (j, m)):
                    sg = cg[b, d] - cg[a, d] - cg[b, c] + cg[a, c]
                    sh = ch[b, d] - ch[a, d] - ch[b, c] + ch[a, c]
                    gain += _gain(sg, sh)
                    out[a:b, c:d] = sg / (sh + SMOOTH)
            if gain > best[0]:
                best = gain, out
    return best


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Fit the model. Without rows, or with one label only, every score is
    the smoothed share of label 1."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    intercept = float(np.log(share / (1 - share)))
    if not len(x):
        x = np.zeros((1, len(FEATURES)))
        y = np.array([share])
    n = x.shape[1]
    edges = [_edges(x[:, f], BINS) for f in range(n)]
    coarse = [_edges(x[:, f], PAIR_BINS) for f in range(n)]
    bins = [np.searchsorted(edges[f], x[:, f], "right") for f in range(n)]
    grid = [np.searchsorted(coarse[f], x[:, f], "right") for f in range(n)]
    tables = [np.zeros(len(edges[f]) + 1) for f in range(n)]
    total = np.full(len(x), intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for f in range(n):
            g, h = slopes()
            size = len(tables[f])
            step = RATE * _tree(np.bincount(bins[f], g, size), np.bincount(bins[f], h, size), CUTS)
            tables[f] += step
            total += step[bins[f]]

    def cells(f: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = len(coarse[f]) + 1, len(coarse[k]) + 1
        at = grid[f] * shape[1] + grid[k]
        g, h = slopes()
        return at, *(np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))

    ranked = sorted(
        ((_quadrants(*cells(f, k)[1:])[0], f, k) for f in range(n) for k in range(f + 1, n)), reverse=True
    )
    pairs = [(f, k, np.zeros((len(coarse[f]) + 1, len(coarse[k]) + 1))) for gain, f, k in ranked[:PAIRS] if gain > 0]
    for _ in range(ROUNDS // 5):
        for f, k, table in pairs:
            at, g, h = cells(f, k)
            step = RATE * _quadrants(g, h)[1]
            table += step
            total += step.ravel()[at]
    return AdditiveModel(edges, coarse, intercept, tables, pairs)


# -- Spark ------------------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of the id as text
    leaves remainder 2 by 4 (false for a null id)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
    max_rows: int = MAX_TRAIN,
) -> AdditiveModel:
    """Fit on the labelled, not held-out documents; of more than ``max_rows``
    those with the smallest hash of their id. Null labels and ids are
    ignored; an id with several labels has their rounded mean (halves up)."""
    known = (
        labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(doc_id)))
        .groupBy(F.col(doc_id).alias("_id")).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("_y"))
    )
    # at most max_rows of (id, label)
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    rows = docs.join(F.broadcast(sample), docs[doc_id] == sample["_id"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                x = pa.array(feature_rows(part, 1).tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([part.column(0), x, part.column(2)], names=["id", "x", "y"])

    measured = rows.select(F.col("_id").cast("string"), text, "_y").mapInArrow(measure, "id string, x array<double>, y int")
    found = measured.orderBy(F.xxhash64("id"), "id").limit(2 * max_rows).collect()  # twice: for repeated rows
    x = np.array([r.x for r in found], float).reshape(-1, len(FEATURES))
    return fit(x, np.array([r.y for r in found], float))


def score_quality(
    docs: DataFrame, model: AdditiveModel, text: str = "text", threshold: float = 0.7
) -> DataFrame:
    """``docs`` plus ``score`` (0 to 1, higher: label 1 likelier) and
    ``predicted`` (1 from ``threshold`` on). Whole texts are scored; null ones
    as empty. Repeated rows score alike; an empty table gives an empty
    result; columns named score or predicted are replaced."""
    docs = docs.drop("score", "predicted")
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                s = sent.value.score(feature_rows(part, at))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                    names=[*batch.schema.names, "score", "predicted"],
                )

    return docs.mapInArrow(run, widened(docs, score="double", predicted="int"))
