"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated.

Statistics of a text are standardised and mapped to cosines of random projections, whose inner products
approximate a Gaussian kernel. Partitions sum their shares of the normal equations; the driver solves one
system of FEATURES unknowns. Isotonic regression over binned training scores turns scores into shares of label 1.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import materialise
from quarry.llm.language_id import held_out

FEATURES = 384
#: Width of the kernel in standard deviations of the statistics, and the ridge.
WIDTH, RIDGE = 6.0, 1.0
SEED = 7
#: Partial sums that are added up at a time.
FAN_IN = 16
#: Bins of the scores from -0.5 to 1.5 in which calibration counts labels.
BINS = 400
_CLASS = np.zeros(256, np.int64)
for _i, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".,;:?'\"()-", b"!", b"|", b"#*$%&<>=@~^_+/\\{}[]`"), 1):
    _CLASS[list(_chars)] = _i
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def statistics(text: str | None) -> list[float]:
    """Statistics of a whole text; a null text counts as empty."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    chars, kinds = max(len(text), 1), np.bincount(_CLASS[raw], minlength=10)
    words = _WORD.findall(text)
    n = max(len(words), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(len(lines), 1)
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    upper = sum(map(str.isupper, words))
    common = Counter(words).most_common(1)[0][1] if words else 0
    pairs = len(set(zip(words, words[1:]))) / max(len(words) - 1, 1) if len(words) > 1 else 1.0
    letters = max(kinds[1] + kinds[2] + kinds[0], 1)
    return [
        np.log1p(len(text)), np.log1p(len(words)), lengths.mean(), lengths.std(), np.log1p(lengths.max()),
        upper / n, kinds[1] / letters, *(kinds[k] / chars for k in (0, 3, 5)), *(min(kinds[k] / n, 3.0) for k in (6, 7, 8, 9)),
        len(set(words)) / n, common / n, pairs, np.log1p(len(lines)), np.log1p(len(words) / m), 1 - len(set(lines)) / m if lines else 0.0,
        text.count("!!") / n, sum(1 for w in words if not w[-1:].isalnum()) / n, kinds[4] / chars, sum(1 for x in lines if x.rstrip()[-1:] in ".!?") / m,
    ]


N_STATISTICS = len(statistics("a b"))


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x: the statistics as packed doubles) of every text."""

    def run(batches):
        for b in batches:
            packed = [np.array(statistics(t), "<f8").tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary())], ["doc_id", "x"])

    taken = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return taken.mapInArrow(run, f"doc_id {taken.schema['doc_id'].dataType.simpleString()}, x binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, N_STATISTICS)


def _summed(rows: DataFrame, share) -> np.ndarray | None:
    """The sum over all rows of what share(x, y) gives for a batch, by a tree: no task, nor the driver, gets more than FAN_IN sums."""

    def part(batches):
        total = None
        for b in batches:
            if b.num_rows:
                own = share(_matrix(b.column(0)), b.column(1).to_numpy().astype(float))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])

    def add(t: pa.Table) -> pa.Table:
        total = 0
        for x in t["s"]:
            total = total + np.frombuffer(x.as_py(), "<f8")
        return pa.table({"s": pa.array([total.tobytes()], pa.binary()), "k": t["k"][:1]})

    parts = rows.mapInArrow(part, "s binary").withColumn("k", F.spark_partition_id().cast("long"))
    n = rows.rdd.getNumPartitions()
    while True:
        parts = parts.withColumn("k", F.expr(f"k div {FAN_IN}")).groupBy("k").applyInArrow(add, "s binary, k bigint")
        n = -(-n // FAN_IN)
        if n <= FAN_IN:
            break
    got = parts.select("s").collect()
    return np.sum([np.frombuffer(r[0], "<f8") for r in got], axis=0) if got else None


class Model:
    """A fitted classifier; constant if nothing was labelled."""

    def __init__(self, mean, scale, weights, knots) -> None:
        rng = np.random.default_rng(SEED)
        self.mean, self.scale, self.weights, self.knots = mean, scale, weights, knots
        self.w = rng.normal(0, 1 / WIDTH, (N_STATISTICS, FEATURES))
        self.b = rng.uniform(0, 2 * np.pi, FEATURES)

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ self.w + self.b), np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), *self.knots)


def pool(count: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling adjacent bins that violate the order: knots (score, share of ones), strictly usable by interp."""
    centres = -0.5 + 2.0 * (np.arange(BINS) + 0.5) / BINS
    blocks: list[list[float]] = []  # weight, ones, weighted centre
    for c, n, k in zip(centres, count, ones):
        if n:
            blocks.append([n, k, n * c])
            while len(blocks) > 1 and blocks[-2][1] / blocks[-2][0] >= blocks[-1][1] / blocks[-1][0]:
                last = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    xs = np.array([b[2] / b[0] for b in blocks])
    ys = np.array([(b[1] + 0.5) / (b[0] + 1) for b in blocks])
    # a slight slope keeps apart what isotonic regression makes equal
    return np.concatenate([[-3.0], xs, [4.0]]), np.maximum.accumulate(np.concatenate([[ys[0] * 0.5], ys, [1 - (1 - ys[-1]) * 0.5]]))


def fit(rows: DataFrame) -> Model | None:
    """rows: (x, y 0 or 1), a written table. None if there are none."""
    moments = _summed(rows, lambda x, y: np.concatenate([[len(x)], x.sum(0), (x**2).sum(0)]))
    if moments is None:
        return None
    n, mean = moments[0], moments[1 : N_STATISTICS + 1] / moments[0]
    scale = np.sqrt(np.maximum(moments[N_STATISTICS + 1 :] / n - mean**2, 0))
    model = Model(mean, np.where(scale > 1e-9, scale, 1.0), None, None)

    def equations(x, y):
        z = model.features(x)
        return np.vstack([z.T @ z, z.T @ y]).ravel()

    k = FEATURES + 1
    ab = _summed(rows, equations).reshape(k + 1, k)
    penalty = RIDGE * np.eye(k) * (np.arange(k) < FEATURES)[:, None] / FEATURES
    model.weights = np.linalg.solve(ab[:k] + penalty + 1e-9 * np.eye(k), ab[k])

    def bins(x, y):
        at = np.clip(((model.raw(x) + 0.5) / 2.0 * BINS).astype(int), 0, BINS - 1)
        return np.concatenate([np.bincount(at, minlength=BINS).astype(float), np.bincount(at, y, BINS)])

    counted = _summed(rows, bins)
    model.knots = pool(counted[:BINS], counted[BINS:])
    return model


def quality_classifier(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, folds: int = 5, fold: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document.

    labels: doc_id, quality (0 or 1; null rows teach nothing; repeated rows count each). All labelled rows
    outside the fold are used. Null texts count as empty and are scored; without any label every score is 0.5.
    Null ids are scored, never learned from. Repeated rows are scored each for itself.
    """
    described = materialise(describe(docs))
    known = labels.filter("quality is not null").select(F.col("doc_id"), F.col("quality").cast("double").alias("y"))
    taught = described.filter(~held_out(F.col("doc_id"), folds, fold)).join(known, "doc_id").select("x", "y")
    model = fit(materialise(taught))

    def run(batches):
        for b in batches:
            x = _matrix(b.column(1))
            score = np.clip(model.score(x), 0.0, 1.0) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score)], ["doc_id", "score"])

    kind = described.schema["doc_id"].dataType.simpleString()
    scored = described.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
