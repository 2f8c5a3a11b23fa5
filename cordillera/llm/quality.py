"""Quality: votes of the nearest labelled documents in a latent-semantic space.

A text's terms are its words, hashed; n-grams of whether neighbouring words are equal;
and short n-grams of character shapes (lower, upper, digit, letters without case, each
punctuation mark, white space).  Damped, idf-weighted term counts of a labelled sample
give a latent space by truncated singular value decomposition.  The sample's vectors
travel to all tasks, every document meets all of them in blocked exact cosine products,
and the labels of its nearest ``NEIGHBOURS`` vote by similarity.  Either class's votes
are weighted by its share among all labels over that in the sample, so that a score
does not depend on how the sample was drawn.

The sample has at most ``MAX_REFERENCE`` labelled rows, those with the least hashes
of their ids, so what is broadcast is bounded: MAX_REFERENCE x DIMENSIONS numbers
and a projection of TERMS x DIMENSIONS.  Tasks count the sample's terms; the driver
gets the counts, at most TERMS for each row, and never texts.  Every document is scored
by its whole text, in pieces of ``BATCH_CHARS`` characters if it is long; a word longer
than a piece counts as several.

Null and empty texts have their two ends alone as terms.  Texts none of whose
neighbours votes score the share of label 1.  Repeated rows score alike, and equal texts
do; of sample rows that repeat an id the least text counts.  Ties between neighbours go
to the smaller reference number.  Other columns are never read, whatever their names.
Without any labels all scores are 0; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, tidy
from .toxicity import batches_of, held_out, labelled_sample, share_of_ones

#: Labelled rows that the classifier may see, half of them of either class at most.
MAX_REFERENCE = 4_096
DIMENSIONS = 48
#: Terms that shape n-grams, marks of equal neighbours and words may become.
SHAPE_TERMS, MARK_TERMS, WORD_TERMS = 2_048, 4, 4_096
TERMS = SHAPE_TERMS + MARK_TERMS + WORD_TERMS
NEIGHBOURS = 15
#: Similarities below it do not vote.
LEAST_SIMILARITY = 0.05
#: Steps of similarity between 0 and 1.
STEPS = 1_000_000
BLOCK = 256
BATCH_CHARS = 1_000_000
SHAPE_ORDERS = (1, 2, 3)

_LOWER, _UPPER, _DIGIT, _OTHER, _SPACE, _EDGE = 1, 2, 3, 4, 5, 0


def _shapes() -> np.ndarray:
    """A class for each character up to U+FFFF; the rest count as letters without case."""
    table = np.full(0x10000, _OTHER, np.uint8)
    for i in range(0xD800):
        c = chr(i)
        if c.islower():
            table[i] = _LOWER
        elif c.isupper():
            table[i] = _UPPER
        elif c.isspace():
            table[i] = _SPACE
        elif c.isdigit():
            table[i] = _DIGIT
        elif i < 128:
            table[i] = 8 + i  # punctuation and control characters, each its own
    table[0] = _EDGE
    return table


_TABLE: list[np.ndarray] = []


def _shape_codes(codes: np.ndarray) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(_shapes())
    return _TABLE[0][np.minimum(codes, 0xFFFF)].astype(np.uint32)


def _shape_terms(shape: np.ndarray, n: int) -> np.ndarray:
    """The terms of all runs of n shapes."""
    total = np.uint32(n)
    for j in range(n):
        total = total * np.uint32(0x01000193) ^ shape[j : len(shape) - n + 1 + j]
    return (total ^ total >> 13) * np.uint32(0x9E3779B1) >> np.uint32(32 - (SHAPE_TERMS.bit_length() - 1))


def _word_hashes(codes: np.ndarray, shape: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin, and the hash of each."""
    edge = (shape == _SPACE) | (shape == _EDGE)
    begins = np.flatnonzero(edge[:-1] & ~edge[1:]) + 1
    ends = np.flatnonzero(~edge[:-1] & edge[1:]) + 1
    powers = np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(codes), 0x9E3779B97F4A7C15 | 1, np.uint64)])
    prefix = np.r_[np.uint64(0), np.cumsum((codes.astype(np.uint64) + 1) * powers[:-1])]
    inverse = np.multiply.accumulate(np.r_[np.uint64(1), np.full(len(codes), pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64), np.uint64)])
    word = (prefix[ends] - prefix[begins]) * inverse[begins]
    return begins, word ^ word >> np.uint64(29)


def _word_terms(word: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of marks of equal neighbours and of words, a row for each text."""
    again = (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])
    repeat = np.zeros(len(word), np.int64)
    repeat[1:] += 2 * again
    repeat[:-1] += again
    hashed = (word * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - (WORD_TERMS.bit_length() - 1))).astype(np.int64)
    counts = lambda term, size: np.bincount(owner * size + term, minlength=texts * size).reshape(texts, size)
    return counts(repeat, MARK_TERMS), counts(hashed, WORD_TERMS)


def long_counts(text: str) -> np.ndarray:
    """The row of counts of one long text, a piece at a time."""
    out = np.zeros(TERMS)
    words = []
    widest = max(SHAPE_ORDERS) - 1
    padded = f"\0{text}\0"
    for at in range(0, len(padded), BATCH_CHARS):
        before = min(at, widest)
        shape = _shape_codes(np.frombuffer(padded[at - before : at + BATCH_CHARS].encode("utf-32-le", "surrogatepass"), np.uint32))
        for n in SHAPE_ORDERS:  # those that end in this piece
            out[:SHAPE_TERMS] += np.bincount(_shape_terms(shape[max(0, before - n + 1) :], n), minlength=SHAPE_TERMS)
    at = 0
    while at < len(text):
        stop = min(len(text), at + BATCH_CHARS)
        if stop < len(text):  # not within a word, if it can be helped
            cut = next((k for k in range(stop, at, -1) if text[k].isspace()), None)
            stop = stop if cut is None else cut
        codes = np.frombuffer(f"\0{text[at:stop]}\0".encode("utf-32-le", "surrogatepass"), np.uint32)
        words.append(_word_hashes(codes, _shape_codes(codes))[1])
        at = stop
    word = np.concatenate([*words, np.zeros(0, np.uint64)])
    marks, hashed = _word_terms(word, np.zeros(len(word), np.int64), 1)
    out[SHAPE_TERMS:] = np.r_[marks[0], hashed[0]]
    return out


def term_counts(texts: list[str]) -> np.ndarray:
    """A row of ``TERMS`` counts for each text."""
    if len(texts) == 1 and len(texts[0]) > BATCH_CHARS:
        return long_counts(texts[0])[None, :]
    sizes = np.array([len(t) + 2 for t in texts], np.int64)
    codes = np.frombuffer("".join([f"\0{t}\0" for t in texts]).encode("utf-32-le", "surrogatepass"), np.uint32)
    shape = _shape_codes(codes)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), sizes)
    shapes = np.zeros(len(texts) * SHAPE_TERMS)
    for n in SHAPE_ORDERS:
        term = _shape_terms(shape, n)
        same = owner[: len(term)] == owner[n - 1 :]
        shapes += np.bincount((owner[: len(term)] * SHAPE_TERMS + term)[same], minlength=len(shapes))
    begins, word = _word_hashes(codes, shape)
    marks, words = _word_terms(word, owner[begins], len(texts))
    return np.hstack([shapes.reshape(len(texts), SHAPE_TERMS), marks, words])


class Space:
    """A projection to the latent space, and the labelled vectors there.

    ``share``: of label 1 among all labels; by default, in the sample.
    """

    def __init__(self, projection: np.ndarray, vectors: np.ndarray, labels: np.ndarray, share: float | None = None):
        self.projection, self.vectors, self.labels = projection, vectors, labels
        sampled = float(labels.mean()) if len(labels) else 0.0
        self.share = sampled if share is None else share
        both = 0 < sampled < 1
        self.power = np.where(labels == 1, self.share / sampled, (1 - self.share) / (1 - sampled)) if both else np.ones(len(labels))

    @staticmethod
    def weigh(counts: np.ndarray) -> np.ndarray:
        """Damped relative frequencies, so that length alone does not matter."""
        size = np.maximum(1, counts.sum(1, keepdims=True))
        return np.sqrt(counts / size)

    def embed(self, texts: list[str]) -> np.ndarray:
        out = [self.weigh(term_counts(part[i : i + BLOCK])) @ self.projection for _, part in batches_of(texts, BATCH_CHARS) for i in range(0, len(part), BLOCK)]
        found = np.concatenate([*out, np.zeros((0, self.projection.shape[1]))])
        return found / np.maximum(1e-12, np.linalg.norm(found, axis=1, keepdims=True))

    def score(self, texts: list[str]) -> np.ndarray:
        if not len(self.labels):
            return np.zeros(len(texts))
        vectors = self.embed(texts)
        out = np.empty(len(texts))
        known = len(self.labels)
        near = min(NEIGHBOURS, known)
        last = np.arange(known - 1, -1, -1)
        for i in range(0, len(texts), BLOCK):
            # Equal texts get equal scores: similarities count in steps, and ties go by number.
            steps = np.rint(vectors[i : i + BLOCK] @ self.vectors.T * STEPS).astype(np.int64) * known + last
            top = np.argpartition(-steps, near - 1, axis=1)[:, :near]
            top = np.sort(top, axis=1)  # sums do not depend on the order that the partition leaves
            weight = np.take_along_axis(steps, top, 1) // known / STEPS
            weight = np.where(weight >= LEAST_SIMILARITY, weight, 0) * self.power[top]
            total = weight.sum(1)
            votes = (weight * self.labels[top]).sum(1)
            out[i : i + BLOCK] = np.where(total > 0, votes / np.maximum(total, 1e-12), self.share)
        return np.clip(out, 0, 1)


def sample_terms(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighed term counts of the sample's texts in order of id, how many texts hold each term, and labels."""

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            places, values = [], []
            for _, part in batches_of(texts, BATCH_CHARS):
                for i in range(0, len(part), BLOCK):
                    for row in Space.weigh(term_counts(part[i : i + BLOCK])):
                        at = np.flatnonzero(row)
                        places.append(at.astype(np.int32).tobytes())
                        values.append(row[at].astype(np.float32).tobytes())
            columns = [batch.column("labelled_id"), batch.column("y"), pa.array(places, pa.binary()), pa.array(values, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["labelled_id", "y", "places", "values"])

    rows = sample.mapInArrow(frugal(run), "labelled_id long, y int, places binary, values binary").toArrow()
    rows = rows.sort_by([("labelled_id", "ascending"), ("y", "ascending")])
    weighted, held = np.zeros((len(rows), TERMS), np.float32), np.zeros(TERMS, np.int64)
    for k, (at, value) in enumerate(zip(rows.column("places"), rows.column("values"))):
        at = np.frombuffer(at.as_py(), np.int32)
        weighted[k, at] = np.frombuffer(value.as_py(), np.float32)
        held[at] += 1
    return weighted, held, rows.column("y").to_numpy().astype(float)


def fit(sample: DataFrame, share: float | None = None) -> Space:
    weighted, held, labels = sample_terms(sample)
    count = len(labels)
    if not count:
        return Space(np.zeros((TERMS, 1)), np.zeros((0, 1)), labels)
    idf = np.log((1 + count) / (1 + held)) + 0.3
    weighted *= idf.astype(np.float32)
    rank = min(DIMENSIONS, count)
    basis = np.random.default_rng(7).standard_normal((count, min(count, rank + 16))).astype(np.float32)
    for _ in range(4):  # subspace iteration
        basis, _ = np.linalg.qr(weighted @ (weighted.T @ basis))
    _, _, right = np.linalg.svd(basis.T @ weighted, full_matrices=False)
    found = weighted @ right[:rank].T
    vectors = (found / np.maximum(1e-12, np.linalg.norm(found, axis=1, keepdims=True))).astype(float)
    del weighted
    tidy()
    return Space((idf[:, None] * right[:rank].T).astype(float), vectors, labels, share)


def score_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_reference: int = MAX_REFERENCE, threshold: float = 0.3
) -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    score = scorer(docs, labels, id_col, text_col, label_col, max_reference)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), score(F.col(text_col)).alias("score"))
    return rows.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def scorer(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_reference: int):
    """A function of a text column that gives the score column."""
    space = fit(labelled_sample(docs, labels, label_col, id_col, text_col, max_reference // 2), share_of_ones(labels, label_col, id_col))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        try:
            return pd.Series(space.score([t or "" for t in texts]))
        finally:
            tidy()

    return score


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_reference: int = MAX_REFERENCE, threshold: float = 0.3) -> DataFrame:
    """The documents that the classifier accepts, with all their columns."""
    return docs.where(scorer(docs, labels, id_col, text_col, label_col, max_reference)(F.col(text_col)) >= threshold)
