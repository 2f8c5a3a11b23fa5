"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes.

A text's features say which character n-grams it holds, hashed to ``2 ** HASH_BITS``
numbers.  Each is scaled by its naive Bayes log-count ratio, the logarithm of how much
more often it occurs in toxic than in other training texts.  N-grams whose frequencies
in the two classes differ by less than ``MIN_CHI2`` says could be chance and are left
out; all others count, however many they are.  Ridge-penalised logistic regression over
the scaled features, weighted to the classes' shares among all labels, gives the score.

The model is fitted on at most ``MAX_TRAIN`` labelled rows of each class, those with
the least hashes of their ids.  Tasks count n-grams and find features; what the driver
gets is one row for each n-gram that passed and the numbers of those that each
training text holds, never texts.  Every document is scored, by its whole text, in
pieces of ``BATCH_CHARS`` characters if it is long.

Null and empty texts hold no features but their ends and score what these and the
intercept give.  Repeated rows score alike; of training rows that repeat an id the
least text counts.  Ties in the draw go by id.  Other columns are never read, whatever
their names.  Without labels of both classes every score is the share of label 1, or 0
if there are none; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, settled, tidy

#: Labelled rows of each class that the model may see.
MAX_TRAIN = 3_000
#: Tasks that look at them.
SAMPLE_PARTS = 8
ORDERS = (3, 4, 5)
HASH_BITS = 20
#: Chi-square that an n-gram's frequencies in the two classes must reach.
MIN_CHI2 = 10.0
RIDGE = 5.0
#: Characters that are turned into n-grams at once.
BATCH_CHARS = 1_000_000

_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)
_GAP = "\0" * (max(ORDERS) - 1)  # before and after each text, so that n-grams mark its ends


def held_out(id_column: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(id_column.cast("string").cast("binary")) % 5 == 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, most: int) -> DataFrame:
    """labelled_id, y and text of at most ``most`` texts of each class, written once; held-out rows are left out.

    The sample's ids are drawn first, so what is broadcast has ``2 * most`` rows at most.
    """
    rows = labels.where(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    rows = rows.select(F.col(id_col).cast("long").alias("labelled_id"), F.col(label).cast("int").alias("y")).distinct().withColumn("draw", F.xxhash64("labelled_id"))
    drawn = [rows.where(F.col("y") == y).orderBy("draw", "labelled_id").limit(most) for y in (0, 1)]
    drawn = drawn[0].unionByName(drawn[1]).select("labelled_id", "y")
    texts = docs.select(F.col(id_col).cast("long").alias("labelled_id"), F.col(text_col).alias("text"))
    found = texts.join(F.broadcast(drawn), "labelled_id").groupBy("labelled_id", "y").agg(F.min("text").alias("text"))
    return settled(found.repartition(SAMPLE_PARTS, "labelled_id", "y"))


def share_of_ones(labels: DataFrame, label: str, id_col: str) -> float | None:
    """Of all labels that may be learned from."""
    return labels.where(F.col(label).isin(0, 1) & ~held_out(F.col(id_col))).agg(F.avg(label)).first()[0]


def batches_of(texts: list[str], most: int = BATCH_CHARS):
    """Slices of a list of texts with at most so many characters each; a longer text comes alone."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield at, texts[at:i]
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, texts[at:]


def _hashes(codes: np.ndarray) -> list[np.ndarray]:
    """The hashes of all n-grams of a row of characters, by order."""
    out = []
    total = np.zeros(len(codes), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        ends = codes[n - 1 :] * _MULTIPLIERS[n - 1]
        total = total[: len(ends)] + ends
        if n in ORDERS:
            mixed = (total ^ (total >> 15)) * np.uint32(0x2C1B3C6D + 2 * n)
            out.append(mixed >> np.uint32(32 - HASH_BITS))
    return out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts, and the index of the text each is from."""
    lower = [_GAP + " ".join(t.lower().split()) + _GAP for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in lower])
    found, owners = _hashes(_codes("".join(lower))), []
    for k, n in enumerate(ORDERS):  # none reaches from one text into the next
        own = owner[: len(found[k])]
        inside = own == owner[n - 1 :]
        found[k], own = found[k][inside], own[inside]
        owners.append(own)
    return np.concatenate(found), np.concatenate(owners)


def long_grams(text: str) -> np.ndarray:
    """The distinct hashed n-grams of one long text, a piece at a time; pieces overlap by an n-gram."""
    lower = re.sub(r"\s+", " ", text.lower()).strip()
    seen = np.zeros(1 << HASH_BITS, bool)
    for at in range(0, max(1, len(lower)), BATCH_CHARS):
        piece = lower[max(0, at - len(_GAP)) : at + BATCH_CHARS]
        piece = _GAP * (at == 0) + piece + _GAP * (at + BATCH_CHARS >= len(lower))
        for hashes in _hashes(_codes(piece)):
            seen[hashes] = True
    return np.flatnonzero(seen)


def presence(texts: list[str], keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, n-gram) pairs, of the n-grams marked in ``keep`` if given."""
    rows, columns = [], []
    for at, part in batches_of(texts):
        if len(part) == 1 and len(part[0]) > BATCH_CHARS:
            found = long_grams(part[0])
            found = found if keep is None else found[keep[found]]
            rows.append(np.full(len(found), at))
            columns.append(found)
            continue
        hashes, owner = grams(part)
        if keep is not None:
            found = keep[hashes]
            hashes, owner = hashes[found], owner[found]
        pairs = np.unique((owner + at) << HASH_BITS | hashes.astype(np.int64))
        rows.append(pairs >> HASH_BITS)
        columns.append(pairs & ((1 << HASH_BITS) - 1))
    empty = np.zeros(0, np.int64)
    return np.concatenate([*rows, empty]), np.concatenate([*columns, empty])


class Model:
    """Which n-grams count, the weight of each, and the intercept."""

    def __init__(self, columns: np.ndarray, weights: np.ndarray, intercept: float):
        self.columns, self.weights, self.intercept = columns, weights, intercept

    def score(self, texts: list[str]) -> np.ndarray:
        keep = np.zeros(1 << HASH_BITS, bool)
        keep[self.columns] = True
        weights = np.zeros(1 << HASH_BITS)
        weights[self.columns] = self.weights
        rows, columns = presence(texts, keep)
        total = self.intercept + np.bincount(rows, weights[columns], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def class_counts(sample: DataFrame) -> DataFrame:
    """gram, and how many texts of label 1 (p) and 0 (q) hold it."""

    def run(batches):
        p, q = np.zeros(1 << HASH_BITS, np.int64), np.zeros(1 << HASH_BITS, np.int64)
        for batch in batches:
            y = batch.column("y").to_numpy()
            rows, columns = presence([t or "" for t in batch.column("text").to_pylist()])
            p += np.bincount(columns[y[rows] == 1], minlength=len(p))
            q += np.bincount(columns[y[rows] == 0], minlength=len(q))
        some = np.flatnonzero(p + q)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (some, p[some], q[some])], ["gram", "p", "q"])

    found = sample.select("y", "text").mapInArrow(frugal(run), "gram long, p long, q long")
    return found.groupBy("gram").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))


def features(sample: DataFrame, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels of the sample's texts in order of id, and their features: text and place in ``columns``."""

    def run(batches):
        keep = np.zeros(1 << HASH_BITS, bool)
        keep[columns] = True
        for batch in batches:
            rows, found = presence([t or "" for t in batch.column("text").to_pylist()], keep)
            cuts = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            places = np.searchsorted(columns, found).astype(np.int32)
            held = [places[a:b].tobytes() for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("labelled_id"), batch.column("y"), pa.array(held, pa.binary())], ["labelled_id", "y", "held"])

    rows = sample.mapInArrow(frugal(run), "labelled_id long, y int, held binary").toArrow().sort_by([("labelled_id", "ascending"), ("y", "ascending")])
    held = [np.frombuffer(x.as_py(), np.int32) for x in rows.column("held")]
    return rows.column("y").to_numpy().astype(float), np.repeat(np.arange(len(held)), [len(x) for x in held]), np.concatenate([*held, np.zeros(0, np.int32)])


def regression(y: np.ndarray, owner: np.ndarray, place: np.ndarray, ratio: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights and intercept of ridge-penalised logistic regression over sparse rows, by truncated Newton steps."""
    n, size = len(y), len(ratio)
    forward = lambda v: np.bincount(owner, (ratio * v[:-1])[place], minlength=n) + v[-1]
    backward = lambda r: np.r_[np.bincount(place, r[owner], minlength=size) * ratio, r.sum()]
    penalty = np.r_[np.full(size, RIDGE), 1e-6]

    def loss(w: np.ndarray, z: np.ndarray) -> float:
        return float(weight @ (np.logaddexp(0, z) - y * z) + (penalty * w * w).sum() / 2)

    w = np.zeros(size + 1)
    z = forward(w)
    for _ in range(40):
        mean = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        slope = backward(weight * (mean - y)) + penalty * w
        if np.abs(slope).max() < 1e-5 * n:
            break
        bend = weight * np.maximum(mean * (1 - mean), 1e-9)
        scale = 1 / (np.r_[np.bincount(place, bend[owner], minlength=size) * ratio**2, bend.sum()] + penalty)
        step, rest = np.zeros(size + 1), -slope
        along = scale * rest
        norm = first = rest @ along
        for _ in range(60):  # conjugate gradients
            curve = backward(bend * forward(along)) + penalty * along
            a = norm / (along @ curve)
            step += a * along
            rest = rest - a * curve
            after = rest @ (scale * rest)
            if after < 1e-4 * first:
                break
            along, norm = scale * rest + after / norm * along, after
        moved, before, pace = forward(step), loss(w, z), 1.0
        while loss(w + pace * step, z + pace * moved) > before and pace > 1e-4:
            pace /= 2
        w, z = w + pace * step, z + pace * moved
        if pace * np.abs(step).max() < 1e-5:
            break
    return w


def fit(sample: DataFrame, share: float | None = None) -> Model:
    """``share``: of label 1 among all labels; the classes are weighted to it. Default: as sampled."""
    sizes = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    zeros, ones = (float(sizes.get(k, 0)) for k in (0, 1))
    if not ones or not zeros:
        odds = np.clip(ones / max(1, ones + zeros), 1e-9, 1 - 1e-9)
        return Model(np.zeros(0, np.int64), np.zeros(0), float(np.log(odds / (1 - odds))))
    n = ones + zeros
    p, q = F.col("p").cast("double"), F.col("q").cast("double")
    chi2 = F.lit(n) * F.pow(p * (zeros - q) - q * (ones - p), 2) / F.greatest(F.lit(1.0), (p + q) * (n - p - q) * ones * zeros)
    kept = class_counts(sample).where(chi2 >= MIN_CHI2).toArrow().sort_by("gram")  # at most 2 ** HASH_BITS rows
    columns, p, q = (kept.column(c).to_numpy() for c in ("gram", "p", "q"))
    ratio = np.log((p + 1) / (ones + 2)) - np.log((q + 1) / (zeros + 2))
    y, owner, place = features(sample, columns)
    share = ones / n if share is None else share
    weight = np.where(y == 1, share / ones, (1 - share) / zeros) * n
    w = regression(y, owner, place, ratio, weight)
    tidy()
    return Model(columns, w[:-1] * ratio, float(w[-1]))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_train: int = MAX_TRAIN, threshold: float = 0.5
) -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    model = fit(labelled_sample(docs, labels, label_col, id_col, text_col, max_train), share_of_ones(labels, label_col, id_col))

    def run(batches):
        for batch in batches:
            scores = model.score([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores, pa.float64())], ["id", "score"])

    scored = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(frugal(run), "id long, score double")
    return scored.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
