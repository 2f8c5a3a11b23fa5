"""Best-fit packing with the Martello-Toth dominance reduction.

Documents are cut into pieces of at most ``capacity`` tokens.  Since only lengths
matter, the instance is a table of at most ``capacity`` rows, one for each length
and its count, however many pieces there are; it is planned on the driver, and the
plan says which ranks within each length go to which sequences.  Pieces learn their
rank without a sort: each task numbers its own pieces of each length, and sums over
the tasks' counts give the offsets.

Planning first fixes sets that dominate every alternative: a piece that nothing fits
beside, a pair that fills a sequence, and a piece with its largest partner whenever no
two or more pieces fit beside it with a greater sum.  Where no three pieces fit beside
a piece, it is fixed with its best pair if any two others could trade places with that
pair.  Every length is tried, in descending order, until none gives a set any more.
What is left goes best-fit, in descending length.

Null texts count as empty; every document has at least the separator, so an empty
text is one piece of one token.  Ties and repeated rows are packed like any others,
other columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .bpe import codec, encoded, tokenizer_path
from .common import frugal, settled

PIECES = "id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
#: A pattern (its lengths, descending) and how many sequences have it.
Plan = list[tuple[tuple[int, ...], int]]


def dominant(counts: Counter, capacity: int) -> Plan:
    """Take out of ``counts`` the sets that dominate all others, and return them.

    A set fixed with piece j dominates when whatever else stands beside j in some
    packing can trade places with the set's own partner and fit there.
    """
    plan: Plan = []

    def fix(pattern: tuple[int, ...], n: int) -> None:
        plan.append((pattern, n))
        for size in pattern:
            counts[size] -= n
            if not counts[size]:
                del counts[size]

    for size in sorted(counts, reverse=True):  # one piece that fills what the other leaves
        if counts[size] and counts.get(capacity - size) and size >= capacity - size:
            n = counts[size] // 2 if 2 * size == capacity else min(counts[size], counts[capacity - size])
            if n:
                fix((size, capacity - size), n)
    if counts.get(capacity):
        fix((capacity,), counts[capacity])
    found = True
    while found:  # what is fixed leaves fewer sums, so that lengths passed over may be dominated later
        found = False
        for large in sorted(counts, reverse=True):
            while counts.get(large):
                room = capacity - large
                own = [s for s in sorted(counts) if s <= room and (s != large or counts[s] > 1)]
                if not own:
                    fix((large,), counts[large] if large > room else 1)
                    found = True
                    continue
                partner = own[-1]
                if two_between(counts, own, partner, room) or best_sum(counts, own, room) > partner:
                    pair = best_pair({s: counts[s] - (s == large) for s in own}, room)
                    if pair is None:
                        break
                    pattern = tuple(sorted((large, *pair), reverse=True))
                    fix(pattern, min(counts[s] // k for s, k in Counter(pattern).items()))
                    found = True
                    continue
                # Fewer pieces only take sums away, so this holds while both lengths last.
                fix((max(large, partner), min(large, partner)), counts[large] // 2 if partner == large else min(counts[large], counts[partner]))
                found = True
    return plan


def two_between(counts: Counter, sizes: list[int], least: int, room: int) -> bool:
    """Whether two pieces have a sum over ``least`` and at most ``room``: the common case of best_sum, and cheaper."""
    for size in sizes:
        k = bisect_right(sizes, room - size) - 1
        if k >= 0 and sizes[k] + size > least and (sizes[k] != size or counts[size] > 1):
            return True
    return False


def best_pair(left: dict[int, int], room: int) -> tuple[int, int] | None:
    """The two of ``left`` (counts by size, each at most ``room``) that dominate all others in ``room``, if any do.

    No three may fit.  The pair has the greatest sum and the largest piece, and no two others
    that are both larger than its smaller one fit: then one of any two is no larger than
    the pair's larger, and the other no larger than its smaller piece.
    """
    sizes = [s for s in sorted(left) if left[s] > 0]
    few: list[int] = []
    for s in sizes:
        few += [s] * min(3 - len(few), left[s])
    if len(few) < 2 or len(few) == 3 and sum(few) <= room:
        return None
    best, low, high = None, 0, len(sizes) - 1
    while low <= high:
        total = sizes[low] + sizes[high]
        if total > room or low == high and left[sizes[low]] < 2:
            high -= 1
            continue
        if best is None or total > sum(best):
            best = (sizes[high], sizes[low])
        low += 1
    if best is None or best[0] != sizes[-1]:
        return None
    above: list[int] = []
    for s in sizes:
        if s > best[1]:
            above += [s] * min(2 - len(above), left[s] - (s == best[0]))
    return None if len(above) == 2 and sum(above) <= room else best


def best_sum(counts: Counter, sizes: list[int], room: int) -> int:
    """The greatest sum, at most ``room``, of two or more pieces; by reachable sums as bits."""
    mask = (1 << (room + 1)) - 1
    one, more = 0, 0  # reachable with exactly one piece, and with two or more
    for size in sizes:
        for _ in range(min(counts[size], room // size)):
            more |= ((one | more) << size) & mask
            one |= 1 << size
    return more.bit_length() - 1 if more else 0


def best_fit(counts: Counter, capacity: int) -> Plan:
    """Best-fit in descending length, for all pieces of a length at once.

    Sequences with the same contents are kept as one pattern and a count.
    """
    rooms: list[int] = []  # distinct, ascending
    holding: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)

    def put(pattern: tuple[int, ...], room: int, n: int) -> None:
        if room not in holding or not holding[room]:
            insort(rooms, room)
        holding[room].append((pattern, n))

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            k = bisect_left(rooms, size)
            if k == len(rooms):
                each = min(capacity // size, left)
                put((size,) * each, capacity - each * size, n := left // each)
                left -= n * each
                continue
            room = rooms[k]
            pattern, n = holding[room].pop()
            if not holding[room]:
                rooms.pop(k)
            each = min(room // size, left)
            use = min(n, left // each)
            if use < n:
                put(pattern, room, n - use)
            put(pattern + (size,) * each, room - each * size, use)
            left -= use * each
    return [x for room in rooms for x in holding[room]]


def plan_sequences(counts: dict[int, int], capacity: int) -> Plan:
    """Patterns for all pieces, of which there are counts[length] of each length."""
    rest = Counter({k: v for k, v in counts.items() if v})
    return dominant(rest, capacity) + best_fit(rest, capacity)


def placements(plan: Plan) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, ...]]]:
    """For each length: ranks from which a placement holds, its first sequence, copies, and offset."""
    out: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    taken: Counter = Counter()
    sequence = 0
    for pattern, n in plan:
        offset = 0
        for size in pattern:
            out[size].append((taken[size], sequence, offset))
            taken[size] += n
            offset += size
        sequence += n
    return {k: tuple(np.array(x, np.int64) for x in zip(*v)) for k, v in out.items()}


def cut(docs: DataFrame, capacity: int, vocabulary: str, separator: int, id_col: str, text_col: str, folder: str | None) -> DataFrame:
    """One row per piece, numbered by its task within its length."""

    def run(batches):
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for part, ids, bounds in encoded(batches, codec(tokenizer_path(vocabulary, folder))):
            rows = []
            for doc, a, b in zip(part.column("id").to_pylist(), bounds.tolist(), bounds[1:].tolist()):
                own = np.append(ids[a:b], separator).astype("<u4")
                for piece, start in enumerate(range(0, len(own), capacity)):
                    x = own[start : start + capacity]
                    rows.append((doc, piece, start, len(x), zlib.crc32(x), task, seen[len(x)]))
                    seen[len(x)] += 1
            names = [x.split()[0] for x in PIECES.split(", ")]
            kinds = [{"long": pa.int64(), "int": pa.int32()}[x.split()[1]] for x in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(frugal(run), PIECES)


def pack_documents(
    docs: DataFrame,
    capacity: int = 2048,
    vocabulary: str = "word_bpe_49k.json",
    separator: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str | None = None,
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = settled(cut(docs, capacity, vocabulary, separator, id_col, text_col, folder))
    by_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    offsets = by_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    where = placements(plan_sequences(counts, capacity))
    ranked = pieces.join(offsets, ["task", "length"]).select("id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("rank"))

    def place(batches):
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            cuts = np.flatnonzero(np.diff(lengths[order])) + 1
            for at in np.split(order, cuts) if len(order) else []:
                first, begins, offsets = where[int(lengths[at[0]])]
                k = np.searchsorted(first, ranks[at], "right") - 1
                sequence[at] = begins[k] + ranks[at] - first[k]
                offset[at] = offsets[k]
            columns = [batch.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sequence), pa.array(offset)], ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    schema = "id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.mapInArrow(frugal(place), schema).withColumnRenamed("id", id_col)
