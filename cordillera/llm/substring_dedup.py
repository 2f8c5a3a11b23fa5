"""Substring dedup by super-k-mer partitioning.

A window is ``window`` consecutive words of one document.  Its minimiser is the
least hash of the runs of ``seed`` words in it, so equal windows have equal
minimisers, and neighbouring windows mostly share theirs: such a run of windows
travels to its minimiser's bucket as one packed string.  A bucket sorts its windows
by content; a window that also starts in a document with a smaller id is repeated,
and the words it covers are removed.

Only minimisers that occur in two documents or more are packed at all; their counts
come from a grouped sum of (minimiser, document) rows.  A minimiser with more than
``HOT`` occurrences does not go to one bucket: its windows, one by one, are grouped
by a digest of their words: each task keeps its own occurrences, sends one row for
each distinct window of a slice of documents, and gets one back.  The first way
compares whole windows, this one their 160-bit digests; no window is left out.

Windows are judged on the input.  Null texts have no words and stay as they are;
texts shorter than a window keep all words.  Rows that repeat a document id are rows of
their own, told apart by a hash of their texts, and as no id is smaller than itself
they remove nothing from each other; rows without an id keep all words and count for
no other.  Other columns are passed through by ``substring_dedup`` and ignored by
``repeated_spans``, and an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import spread
from .common import frugal, lasting_mark, release, settled
from .words import mix, slices, spans_hash, words_of

WINDOW = 50
SEED = 8
#: Occurrences beyond which a minimiser's windows are grouped one by one.
HOT = 256
#: Packed strings in one batch, and windows in one slice of hot runs.
PACKED_ROWS = 20_000
SLICE_WINDOWS = 200_000
#: Documents with hot runs up to which these are broadcast; more are joined by a shuffle.
BROADCAST_DOCS = 200_000
#: What texts are called while they are joined; see ``repeated_spans``.
BODY = "__body"
HOT_SLICES = "slice string, ids array<long>, marks array<long>, first array<long>, code array<long>, digests array<binary>, low array<long>, high array<long>"
_SALT = np.uint64(0xA0761D6478BD642F)


def minimisers(hashes: np.ndarray, first: np.ndarray, window: int, seed: int) -> np.ndarray:
    """The least seed hash in each window that begins at ``first``."""
    seeds = len(hashes) - seed + 1
    if seeds <= 0 or not len(first):
        return np.zeros(0, np.uint64)
    starts = np.arange(seeds)
    least = mix(spans_hash(hashes, starts, starts + seed) ^ _SALT)
    span, done = window - seed + 1, 1
    while done < span:  # least over 1, 2, 4, ... seeds; parts may overlap
        step = min(done, span - done)
        least = np.minimum(least[: len(least) - step], least[step:])
        done += step
    return least[first]


def _occurrences(window: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = words_of(part.column("text"))
            first, text = words.windows(window)
            least = minimisers(words.hashes, first, window, seed)
            if not len(first):
                continue
            new = np.r_[True, (least[1:] != least[:-1]) | (text[1:] != text[:-1])]
            at = np.flatnonzero(new)
            runs = np.diff(np.r_[at, len(first)])
            ids = part.column("id").to_numpy()
            marks = part.column("mark").to_numpy()
            columns = [least[at].view(np.int64), ids[text[at]], marks[text[at]], (first[at] - words.bounds[text[at]]).astype(np.int32), runs.astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["mini", "id", "mark", "first", "n"])

    return run


def _cut_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[bytes], list[dict]]]:
    """id, mark, words and listed runs of windows of each document that has any."""
    for part in slices(batches):
        own = [x for x in zip(*(part.column(c).to_pylist() for c in ("id", "mark", "text", "runs"))) if x[3]]
        for i, mark, text, runs in own:
            yield i, mark, text.encode().split(), runs


def _packed(window: int):
    """One packed string for each listed run of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: tuple[list, ...] = ([], [], [], [], [])

        def flush() -> pa.RecordBatch:
            nonlocal out
            columns = [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()))]
            out = ([], [], [], [], [])
            return pa.RecordBatch.from_arrays(columns, ["mini", "id", "mark", "first", "packed"])

        for i, mark, words, runs in _cut_runs(batches):
            for r in runs:
                for x, y in zip(out, (r["mini"], i, mark, r["first"], b" ".join(words[r["first"] : r["first"] + r["n"] + window - 1]))):
                    x.append(y)
            if len(out[0]) >= PACKED_ROWS:
                yield flush()
        yield flush()

    return run


def _hot_slices(window: int):
    """The windows of listed runs by slice of documents: occurrences, and each distinct window once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        known: dict[bytes, int] = {}
        held: tuple[list, ...] = ([], [], [], [])

        def flush() -> pa.RecordBatch:
            nonlocal made, known, held
            ids, marks, first, code = (np.array(x, np.int64) for x in held)
            low = np.full(len(known), np.iinfo(np.int64).max)
            high = np.full(len(known), np.iinfo(np.int64).min)
            np.minimum.at(low, code, ids)
            np.maximum.at(high, code, ids)
            columns = [pa.array([f"{task}-{made}"])]
            columns += [pa.array([x], pa.list_(pa.int64())) for x in (ids, marks, first, code)]
            columns += [pa.array([list(known)], pa.list_(pa.binary()))] + [pa.array([x], pa.list_(pa.int64())) for x in (low, high)]
            made, known, held = made + 1, {}, ([], [], [], [])
            return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in HOT_SLICES.split(", ")])

        for i, mark, words, runs in _cut_runs(batches):
            for r in runs:
                for k in range(r["first"], r["first"] + r["n"]):
                    digest = hashlib.blake2b(b" ".join(words[k : k + window]), digest_size=20).digest()
                    for x, y in zip(held, (i, mark, k, known.setdefault(digest, len(known)))):
                        x.append(y)
            if len(held[0]) >= SLICE_WINDOWS:
                yield flush()
        if held[0]:
            yield flush()

    return run


def _hot_spans(window: int):
    """Repeated spans of slices, given the least id that each of their windows has anywhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                low = np.full(row["size"], np.iinfo(np.int64).max)
                for x in row["lows"]:
                    low[x["at"]] = x["low"]
                ids, marks, first, code = (np.array(row[c], np.int64) for c in ("ids", "marks", "first", "code"))
                found = low[code] < ids
                yield _spans(first[found], ids[found], marks[found], window)

    return run


def repeated_windows(words: list[bytes] | pa.Array, bounds: np.ndarray, ids: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the windows of packed strings; which string and place the repeated ones have.

    ``words`` of string i are bounds[i] to bounds[i + 1]. A window is repeated if an
    equal one is in a string with a smaller id. Equality is of words, not of hashes:
    a hash only orders the windows, and neighbours with equal hashes are compared.
    """
    codes = pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy()
    counts = np.maximum(np.diff(bounds) - window + 1, 0)
    string = np.repeat(np.arange(len(counts)), counts)
    at = spread(bounds[:-1], counts)
    hashes = spans_hash(mix(codes.astype(np.uint64)), at, at + window)
    own = ids[string]
    order = np.lexsort((own, hashes))
    hashes, own, place, source = hashes[order], own[order], at[order], string[order]
    same = np.zeros(len(order), bool)
    same[1:] = hashes[1:] == hashes[:-1]
    k = np.flatnonzero(same)
    equal = np.ones(len(k), bool)
    for j in range(window):
        equal &= codes[place[k] + j] == codes[place[k - 1] + j]
    if not equal.all():  # different windows share a hash: order them by their words
        rows = np.stack([codes[at + j] for j in range(window)], 1)
        _, kind = np.unique(rows, axis=0, return_inverse=True)
        order = np.lexsort((ids[string], kind.ravel()))
        kind, own, place, source = kind.ravel()[order], ids[string][order], at[order], string[order]
        same[1:] = kind[1:] == kind[:-1]
    leader = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    found = own > own[leader]
    return source[found], place[found] - bounds[source[found]]


def _spans(first: np.ndarray, ids: np.ndarray, marks: np.ndarray, window: int) -> pa.RecordBatch:
    """Covered word spans of each row, overlapping ones merged."""
    order = np.lexsort((first, marks, ids))
    first, ids, marks = first[order], ids[order], marks[order]
    new = np.r_[True, (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1]) | (first[1:] > first[:-1] + window)][: len(first)]
    at = np.flatnonzero(new)
    last = np.r_[at[1:], len(first)][: len(at)] - 1
    columns = [ids[at], marks[at], first[at], first[last] + window]
    return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in columns], ["id", "mark", "begin", "stop"])


def _bucket(window: int):
    """Repeated spans of rows sorted by minimiser; rows of one minimiser are looked at together."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        ids, marks, first = (table.column(c).to_numpy() for c in ("id", "mark", "first"))
        split = [x.split(b" ") for x in table.column("packed").to_pylist()]
        bounds = np.r_[0, np.cumsum([len(x) for x in split])]
        string, place = repeated_windows([w for x in split for w in x], bounds, ids, window)
        return _spans(first[string].astype(np.int64) + place, ids[string], marks[string], window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, table]) if rest is not None and rest.num_rows else table
            if not table.num_rows:
                continue
            minis = table.column("mini").to_numpy()
            whole = int(np.searchsorted(minis, minis[-1]))  # the last minimiser may go on
            if whole:
                yield solve(table.slice(0, whole))
            rest = table.slice(whole)
        if rest is not None and rest.num_rows:
            yield solve(rest)

    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED, hot: int = HOT, mark: Column | None = None) -> DataFrame:
    """Spans of words [begin, stop) that repeated windows cover: id, mark, begin, stop; a document's spans may overlap.

    ``mark`` tells rows of one id apart (see ``lasting_mark``).
    """
    mark = lasting_mark(docs, id_col, text_col) if mark is None else mark
    # The same rows are shuffled by id and mark here and in _with_spans. Spark does it once if both
    # plans are the same, so a text has a name of its own: renaming to the old one is kept in some plans only.
    texts = docs.select(F.col(id_col).cast("long").alias("id"), mark.alias("mark"), F.col(text_col).alias(BODY)).where("id is not null")
    with_runs = lambda rows: texts.join(rows, ["id", "mark"]).select("id", "mark", F.col(BODY).alias("text"), "runs")
    runs = settled(texts.withColumnRenamed(BODY, "text").mapInArrow(frugal(_occurrences(window, seed)), "mini long, id long, mark long, first int, n int"))
    counted = runs.groupBy("mini").agg(F.count(F.lit(1)).alias("c"), F.min("id").alias("low"), F.max("id").alias("high"))
    shared = settled(runs.join(counted.where("low < high").select("mini", "c"), "mini"))
    del runs, counted
    release(docs.sparkSession)
    listed = lambda rows: rows.groupBy("id", "mark").agg(F.collect_set(F.struct("mini", "first", "n")).alias("runs"))
    cool = with_runs(listed(shared.where(F.col("c") <= hot))).mapInArrow(frugal(_packed(window)), "mini long, id long, mark long, first int, packed binary")
    spans = cool.repartition("mini").sortWithinPartitions("mini").mapInArrow(frugal(_bucket(window)), "id long, mark long, begin long, stop long")
    warm = settled(listed(shared.where(F.col("c") > hot)))
    warm = F.broadcast(warm) if warm.count() <= BROADCAST_DOCS else warm
    held = settled(with_runs(warm).mapInArrow(frugal(_hot_slices(window)), HOT_SLICES))
    each = held.select("slice", F.posexplode(F.arrays_zip("digests", "low", "high")).alias("at", "x")).select("slice", "at", "x.digests", "x.low", "x.high")
    least = each.groupBy("digests").agg(F.min("low").alias("low"), F.max("high").alias("top")).where("low < top").select("digests", "low")
    back = each.select("slice", "at", "digests").join(least, "digests").groupBy("slice").agg(F.collect_list(F.struct("at", "low")).alias("lows"))
    again = held.select("slice", "ids", "marks", "first", "code", F.size("digests").alias("size")).join(back, "slice")
    return spans.unionByName(again.mapInArrow(frugal(_hot_spans(window)), "id long, mark long, begin long, stop long"))


def _kept(row_words: list[bytes], spans: list) -> list[bytes]:
    out, at = [], 0
    for begin, stop in sorted((s["begin"], s["stop"]) for s in spans):
        out.extend(row_words[at:begin])
        at = max(at, stop)
    return out + row_words[at:]


def _with_spans(docs: DataFrame, id_col: str, text_col: str, window: int, seed: int, hot: int) -> DataFrame:
    mark = lasting_mark(docs, id_col, text_col)
    spans = repeated_spans(docs, id_col, text_col, window, seed, hot, mark)
    spans = spans.groupBy(F.col("id").alias("__span_id"), F.col("mark").alias("__span_mark")).agg(F.collect_set(F.struct("begin", "stop")).alias("__spans"))
    known = docs.withColumn("__mark", mark).select(id_col, "__mark", *[F.col(f"`{c}`") for c in docs.columns if c != id_col]).where(docs[id_col].isNotNull())
    out = known.join(spans, (known[id_col] == spans["__span_id"]) & (known["__mark"] == spans["__span_mark"]), "left").select(*[F.col(f"`{c}`") for c in docs.columns], "__spans")
    nameless = docs.where(docs[id_col].isNull()).withColumn("__spans", F.lit(None).cast(spans.schema["__spans"].dataType))
    return out.unionByName(nameless)


def substring_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, seed: int = SEED, hot: int = HOT) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""

    def run(batches):
        for batch in batches:
            out: tuple[list, ...] = ([], [], [])
            for text, spans in zip(batch.column(BODY), batch.column("__spans").to_pylist()):
                own = (text.as_py() or "").encode().split()
                kept = _kept(own, spans) if spans else own
                out[0].append(len(own))
                out[1].append(len(own) - len(kept))
                out[2].append(hashlib.sha256(b" ".join(kept)).hexdigest())
            columns = [batch.column("id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "n_removed", "kept_sha256"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias(BODY))
    return _with_spans(rows, "id", BODY, window, seed, hot).mapInArrow(frugal(run), "id long, n_words long, n_removed long, kept_sha256 string").withColumnRenamed("id", id_col)


def substring_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars", window: int = WINDOW, seed: int = SEED, hot: int = HOT
) -> DataFrame:
    """The documents with their columns, repeated words removed.

    Texts that lose nothing stay as they are, white space included; others become
    their kept words joined by one space. Documents that lose all words are dropped.
    """
    marked = _with_spans(docs, id_col, text_col, window, seed, hot)

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, spans in batches:
            yield pa.array([b" ".join(_kept(t.encode().split(), s)).decode() if s else t for t, s in zip(texts.to_pylist(), spans.to_pylist())], pa.string())

    @F.arrow_udf("string")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        yield from frugal(run)(batches)

    cut = cut.asNondeterministic()  # else Spark has a second worker cut each text again for the condition below
    text = F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(cut(F.col(text_col), F.col("__spans")))
    out = marked.withColumn("__cut", text).where(F.col("__spans").isNull() | (F.col("__cut") != ""))
    columns = [F.col("__cut").alias(text_col) if c == text_col else F.length("__cut").cast(docs.schema[c].dataType).alias(c) if c == chars_col else F.col(f"`{c}`") for c in docs.columns]
    return out.select(*columns)
