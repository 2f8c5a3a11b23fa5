"""N-gram Jaccard join in the metric space of shingle sets.

Two documents link when ``100 * intersection >= percent * union`` of their sets of
distinct word shingles; the Jaccard distance obeys the triangle inequality, so with
d <= e between linked documents their distances to any pivot differ by e at most.

1.  Equal sets are one member.  Of each set only a prefix in hash order is looked
    at first, long enough that linked sets share at least k hashes of it (k grows
    with the set).  Buckets of packed hashes find those that occur in two documents;
    sets with fewer than k such hashes link with nothing.
2.  The members that share a hash elect a pivot, the least id.  A member's distance
    to every other pivot is 1 or comes with few shared hashes, so it belongs to the
    Voronoi region of its nearest pivots, and is replicated to those farther ones it
    cannot leave without risking a link.
3.  A region of up to ``BLOCK`` members is compared by one task.  Members of larger ones
    are looked at once more, with prefixes in another order: hashes that made regions
    large come last, by a bitmap of fixed size that every task has.  Any order that all
    tasks agree on finds every link, so what many documents share stops to bring them
    together, unless they have little else.
4.  Regions that stay large are divided by metric: up to ``PIVOTS`` of their members become
    pivots, each member goes to the cell of its nearest pivot, and to each later cell whose
    pivot is no more than 2e farther, since a link could reach there.  Members within e of
    a pivot are linked to it; a cell whose members are all linked to one pivot is done.
    Cells are regions again, small or divided in turn; a region that its pivots do not part
    is compared in pairs of blocks, except those whose members are linked already.
5.  Verified links, reduced to a spanning forest in each task, give the components.

Nothing is sampled or capped.  Shingles are 64-bit hashes of their words.  Null texts
and texts without words have no shingles, link with nothing and are their own
component; a text with fewer words than a shingle is one shingle.  Repeated rows are
equal sets.  Rows that repeat an id or have none are documents like others; a component
takes the least id that its rows have, or null.  ``keep_one_of_each`` keeps one row of
each component.  Other columns are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .bpe import spread
from .common import BROADCAST_IDS, frugal, grouped, keyed, partitions, release, settled, sized
from .components import Forest, components
from .words import mix, slices, spans_hash, words_of

SHINGLE = 5
PERCENT = 75
#: Share of a set's hashes, in percent, that linked prefixes must have in common.
COMMON = 10
#: Prefix hashes in one packed slice.
SLICE = 300_000
#: Members of a region that a task compares.
BLOCK = 1_024
#: Sets whose intersections with others are counted at once.
LEAF = 256
#: Members of large regions that one task of a later level looks at.
LEVEL_ROWS = 512
#: Times that members are looked at, each time in a new order of hashes; another time is worth it
#: only while the members of large regions become fewer than so large a share of those before.
LEVELS = 4
SHRINK = 0.5
#: Prefix hashes in one bucket, about, where members of large regions are looked at again.
BUCKET = 100_000
#: Bits of the map of hashes that come last.
LATE_BITS = 1 << 23
#: Pivots that divide a region at once, and how often regions are divided.
PIVOTS = 16
DEPTH = 6

SLICES = "slice string, ids array<long>, sizes array<int>, sums array<long>, marks array<long>, lengths array<int>, prefix binary"


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, in a row, and their bounds."""
    words = words_of(texts, lower=True)
    counts = np.diff(words.bounds)
    first, text = words.windows(width)
    hashes = words.sequence_hashes(first, width)
    few = np.flatnonzero((counts > 0) & (counts < width))
    alone = spans_hash(words.hashes, words.bounds[few], words.bounds[few + 1])
    hashes, text = np.r_[hashes, alone], np.r_[text, few]
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    return hashes[new], np.r_[0, np.cumsum(np.bincount(text[new], minlength=len(texts)))].astype(np.int64)


def least_overlap(sizes: np.ndarray, percent: int) -> np.ndarray:
    """The overlap that a set of this size has with any set it links with, at least."""
    return -(-percent * sizes // 100)


def common_needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of its prefix that a set shares with each set it links with, at least."""
    return np.maximum(1, COMMON * least_overlap(sizes, percent) // 100)


def prefix_lengths(sizes: np.ndarray, percent: int) -> np.ndarray:
    k = np.maximum(1, COMMON * sizes // 100)
    return np.where(sizes > 0, np.minimum(sizes, sizes - least_overlap(sizes, percent) + k), 0)


def _prefixes(width: int, percent: int, late: np.ndarray | None):
    """Slices of documents: ids, set sizes, set fingerprints, and packed prefixes.

    Hashes that the bitmap ``late`` marks come after all others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, made = TaskContext.get().partitionId(), 0
        held: list[list[np.ndarray]] = [[] for _ in range(6)]

        def flush() -> pa.RecordBatch:
            nonlocal made, held
            ids, sizes, sums, marks, lengths, prefix = (np.concatenate(x) for x in held)
            name, made, held = f"{task}-{made}", made + 1, [[] for _ in range(6)]
            columns = [pa.array([name])]
            columns += [pa.array([x], pa.list_(t)) for x, t in ((ids, pa.int64()), (sizes, pa.int32()), (sums, pa.int64()), (marks, pa.int64()), (lengths, pa.int32()))]
            return pa.RecordBatch.from_arrays([*columns, pa.array([prefix.tobytes()], pa.binary())], [x.split()[0] for x in SLICES.split(", ")])

        for part in slices(batches):
            hashes, bounds = shingle_sets(part.column("text"), width)
            sizes = np.diff(bounds)
            sums = np.r_[np.uint64(0), np.cumsum(hashes)]
            marks = np.r_[np.uint64(0), np.cumsum(mix(hashes))]
            lengths = prefix_lengths(sizes, percent)
            if late is not None:
                at = hashes & np.uint64(8 * len(late) - 1)
                last = late[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1
                owner = np.repeat(np.arange(len(sizes)), sizes)
                hashes = hashes[np.lexsort((hashes, last, owner))]
            sums, marks = ((x[bounds[1:]] - x[bounds[:-1]]).view(np.int64) for x in (sums, marks))
            for k, x in enumerate((part.column("id").to_numpy(), sizes, sums, marks, lengths, hashes[spread(bounds[:-1], lengths)])):
                held[k].append(x)
            if sum(map(len, held[5])) >= SLICE or sum(map(len, held[0])) >= SLICE:
                yield flush()
        if held[0]:
            yield flush()

    return run


def short_keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and low half of each hash. Different hashes with one key are rare, and only add candidates."""
    return (hashes >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | hashes & np.uint64(0xFFFFFFFF)


def _to_buckets(buckets: int):
    """A slice's distinct prefix keys by bucket, each marked if two of its documents have it."""

    def run(batches):
        for batch in batches:
            for name, prefix in zip(batch.column("slice").to_pylist(), batch.column("prefix")):
                keys, counts = np.unique(short_keys(np.frombuffer(prefix.as_py(), np.uint64), buckets), return_counts=True)
                bucket = (keys >> np.uint64(32)).astype(np.int64)
                low, twice = keys.astype(np.uint32), counts > 1
                cuts = np.r_[0, np.flatnonzero(np.diff(bucket)) + 1, len(bucket)] if len(bucket) else np.zeros(1, np.int64)
                spans = list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(bucket[a]) for a, _ in spans], pa.int32()),
                        pa.array([name] * len(spans), pa.string()),
                        pa.array([low[a:b].tobytes() for a, b in spans], pa.binary()),
                        pa.array([np.packbits(twice[a:b]).tobytes() for a, b in spans], pa.binary()),
                    ],
                    ["bucket", "slice", "keys", "twice"],
                )

    return run


def _shared(table: pa.Table) -> pa.RecordBatch:
    """Of one bucket: for each slice its keys that two documents or more have."""
    parts = [np.frombuffer(x.as_py(), np.uint32) for x in table.column("keys")]
    twice = np.concatenate([np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(k)).astype(bool) for x, k in zip(table.column("twice"), parts)])
    keys = np.concatenate(parts)
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    found = np.empty(len(keys), bool)
    found[order] = same[1:] | same[:-1]
    found |= twice
    bucket = np.uint64(table.column("bucket")[0].as_py()) << np.uint64(32)
    ends = np.cumsum([len(k) for k in parts])
    kept = [(bucket | k[found[e - len(k) : e]]).astype(np.uint64).tobytes() for k, e in zip(parts, ends)]
    return pa.RecordBatch.from_arrays([table.column("slice").combine_chunks(), pa.array(kept, pa.binary())], ["slice", "shared"])


def _survivors(percent: int, buckets: int):
    """Documents that share enough prefix hashes with others: id, size, the shared hashes."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shared = np.sort(np.frombuffer(b"".join(row["shared"]), np.uint64))
                prefix = np.frombuffer(row["prefix"], np.uint64)
                keys = short_keys(prefix, buckets)
                at = np.minimum(np.searchsorted(shared, keys), max(0, len(shared) - 1))
                hit = shared[at] == keys if len(shared) else np.zeros(len(prefix), bool)
                owner = np.repeat(np.arange(len(row["ids"])), row["lengths"])
                sizes = np.array(row["sizes"], np.int64)
                count = np.bincount(owner[hit], minlength=len(sizes))
                stays = (count >= common_needed(sizes, percent)) & (sizes > 0)
                use = hit & stays[owner]
                offsets = np.r_[0, np.cumsum(count[stays])].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(prefix[use].view(np.int64)))
                ids = pa.array(np.array(row["ids"], np.int64)[stays])
                yield pa.RecordBatch.from_arrays([ids, pa.array(sizes[stays].astype(np.int32)), lists], ["id", "size", "shared"])

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, from columns of an incidence matrix a block at a time."""
    m = len(sets)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[code] > 1  # what one set alone has is in no intersection
    place = np.cumsum(count > 1) - 1
    code, owner = place[code[shared]], owner[shared]
    out = np.zeros((m, m), np.float64)
    width = max(1, 8_000_000 // max(1, m))
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    top = int(code[-1]) + 1 if len(code) else 0
    for at in range(0, top, width):
        a, b = np.searchsorted(code, [at, at + width])
        block = np.zeros((m, min(width, top - at)), np.float32)
        block[owner[a:b], code[a:b] - at] = 1
        out += block @ block.T
    out[np.arange(m), np.arange(m)] = [len(s) for s in sets]
    return out


def linked(sizes: np.ndarray, common: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)


def _compare(percent: int):
    """Spanning forest of the links among one group's members (a region or a pair of blocks)."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        ids = table.column("id").to_numpy()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("hashes")]
        sizes = np.array([len(s) for s in sets], np.float64)
        forest = Forest()
        order = np.argsort(sizes, kind="stable")  # sizes of linked sets differ little
        at = 0
        while at < len(order):
            end = int(np.searchsorted(sizes[order], 100 * sizes[order[min(at + LEAF, len(order)) - 1]] / percent + 1e-9, "right"))
            part = order[at:end]
            i, j = np.nonzero(np.triu(linked(sizes[part], overlaps([sets[k] for k in part]), percent), 1))
            for a, b in zip(ids[part[i]].tolist(), ids[part[j]].tolist()):
                forest.join(a, b)
            at += LEAF
        members, roots = forest.edges()
        return pa.RecordBatch.from_arrays([pa.array(members, pa.int64()), pa.array(roots, pa.int64())], ["a", "b"])

    return solve


def _sets(width: int):
    def run(batches):
        for part in slices(batches):
            hashes, bounds = shingle_sets(part.column("text"), width)
            packed = [hashes[a:b].tobytes() for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(packed, pa.binary())], ["id", "hashes"])

    return run


def crossing(members: list[np.ndarray], pivots: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each member with each pivot."""
    codes, place = np.unique(np.concatenate(pivots), return_inverse=True)
    inside = np.zeros((len(pivots), len(codes)), bool)
    inside[np.repeat(np.arange(len(pivots)), [len(p) for p in pivots]), place] = True
    flat, owner = np.concatenate(members), np.repeat(np.arange(len(members)), [len(x) for x in members])
    at = np.minimum(np.searchsorted(codes, flat), len(codes) - 1)
    hit = codes[at] == flat
    at, owner = at[hit], owner[hit]
    return np.stack([np.bincount(owner[own[at]], minlength=len(members)) for own in inside], 1)


CELLS = "region string, child string, own boolean, id long, label long, a long, b long"


def _cells(percent: int):
    """Of members of one region (rows of kind 1) and its pivots (kind 0): cells, labels, and links with pivots.

    A label is the least of the pivots that a member's nearest pivot is linked to,
    itself included, if the member is linked to it; else what it had before.
    """

    def solve(table: pa.Table) -> pa.RecordBatch:
        region = table.column("region")[0].as_py()
        is_pivot = table.column("kind").to_numpy() == 0
        ids = table.column("id").to_numpy()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("hashes")]
        old = table.column("label").to_pylist()
        pivots, members = np.flatnonzero(is_pivot), np.flatnonzero(~is_pivot)
        pivots = pivots[np.argsort(ids[pivots], kind="stable")]
        names = [x.split()[0] for x in CELLS.split(", ")]
        kinds = [{"string": pa.string(), "boolean": pa.bool_(), "long": pa.int64()}[x.split()[1]] for x in CELLS.split(", ")]
        if not len(members) or not len(pivots):
            return pa.RecordBatch.from_arrays([pa.array([], k) for k in kinds], names)
        pivot_sets, member_sets = [sets[k] for k in pivots], [sets[k] for k in members]
        size_p, size_m = (np.array([len(x) for x in own], np.int64) for own in (pivot_sets, member_sets))

        def shares(own: list[np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            common = crossing(own, pivot_sets)
            total = sizes[:, None] + size_p[None, :] - common
            return 1 - common / total, 100 * common >= percent * total

        forest = Forest()
        _, linked_p = shares(pivot_sets, size_p)
        for i, j in zip(*np.nonzero(np.triu(linked_p, 1))):
            forest.join(int(ids[pivots[i]]), int(ids[pivots[j]]))
        far, linked_m = shares(member_sets, size_m)
        nearest = far.argmin(1)
        window = far <= far[np.arange(len(members)), nearest][:, None] + 2 * (100 - percent) / 100 + 1e-9
        window &= np.arange(len(pivots))[None, :] > nearest[:, None]
        window[np.arange(len(members)), nearest] = True
        label = [forest.find(int(ids[pivots[p]])) if linked_m[k, p] else old[m] for k, (m, p) in enumerate(zip(members, nearest.tolist()))]
        rows = [(region, f"{region}/{j}", j == nearest[k], int(ids[members[k]]), label[k], None, None) for k, j in zip(*(x.tolist() for x in np.nonzero(window)))]
        rows += [(region, None, None, None, None, int(ids[members[k]]), int(ids[pivots[j]])) for k, j in zip(*(x.tolist() for x in np.nonzero(linked_m)))]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return solve


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _by_group(rows: DataFrame, sets: DataFrame, group: str, percent: int) -> DataFrame:
    """Links among the members (id) of each group, each compared by one task."""
    dealt = rows.select(group, "id").join(sets, "id")
    return dealt.repartition(group).sortWithinPartitions(group).mapInArrow(frugal(grouped(group, _compare(percent))), "a long, b long")


def _pairs_of_blocks(rows: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links among the members of regions, block against block; members with one label are linked already."""
    sizes = rows.groupBy("region", "label").agg(F.count(F.lit(1)).alias("c"))
    whole = sizes.groupBy("region").agg(F.sum("c").alias("n"))
    each = F.least(F.lit(4 * block), F.greatest(F.lit(block), F.ceil(F.col("n") / 32)))
    parts = sized(sizes.join(whole, "region").select("region", "label", F.ceil(F.col("c") / each).cast("int").alias("parts")))
    right = parts.select(F.col("region").alias("r"), F.col("label").alias("l"), "parts")
    placed = settled(rows.join(right, (rows["region"] == right["r"]) & rows["label"].eqNullSafe(right["l"])).select("region", "label", "id", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part")))
    blocks = parts.select("region", "label", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    place = lambda c: F.struct(F.col("label").isNull().alias("none"), "label", "part").alias(c)
    salts = 16
    p = blocks.select("region", place("p"), F.pmod(F.xxhash64("label", "part"), F.lit(salts)).alias("salt"))
    q = blocks.select("region", place("q"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    pairs = p.join(q, ["region", "salt"]).where("p <= q and not (p.label <=> q.label and not p.none)")
    name = F.concat_ws("-", "region", *[F.coalesce(F.col(c).cast("string"), F.lit("n")) for c in ("p.label", "p.part", "q.label", "q.part")]).alias("pair")
    sides = pairs.select(name, "region", "p.label", "p.part").unionByName(pairs.where("p < q").select(name, "region", "q.label", "q.part"))
    sides = sides.select("pair", F.col("region").alias("r"), F.col("label").alias("l"), F.col("part").alias("k"))
    same = (placed["region"] == sides["r"]) & placed["label"].eqNullSafe(sides["l"]) & (placed["part"] == sides["k"])
    return _by_group(placed.join(sides, same).select("pair", "id"), sets, "pair", percent)


def _divided(regions: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links in regions (region, id, label) of more than ``block`` members, by recursive cells."""
    links: list[DataFrame] = []
    pairs: list[DataFrame] = []
    for depth in range(DEPTH):
        sizes = regions.groupBy("region").agg(F.count(F.lit(1)).alias("n"))
        sizes = sized(sizes.select("region", F.ceil(F.col("n") / block).cast("int").alias("parts"), F.least(F.lit(PIVOTS), F.ceil(F.col("n") / block) + 1).cast("int").alias("m")))
        rows = regions.join(sizes, "region")
        draw = F.xxhash64("id", F.lit(depth))
        picks = rows.groupBy("region", "parts", F.pmod(draw, "m").alias("j")).agg(F.min_by("id", F.struct(F.xxhash64("id", F.lit(depth), F.lit(1)), "id")).alias("id"))
        none = F.lit(None).cast("long").alias("label")
        bundles = picks.join(sets, "id").select("region", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "id", "hashes", none)
        own = rows.join(sets, "id").select("region", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"), F.lit(1).alias("kind"), "id", "hashes", "label")
        dealt = own.unionByName(bundles).select(F.concat_ws(":", "region", "part").alias("deal"), "region", "kind", "id", "hashes", "label")
        found = settled(dealt.repartition("deal").sortWithinPartitions("deal").mapInArrow(frugal(grouped("deal", _cells(percent))), CELLS))
        links.append(found.where("b is not null and a <> b").select("a", "b"))
        cells = found.where("child is not null")
        stats = cells.groupBy("region", "child").agg(F.count(F.lit(1)).alias("n"), F.count_if("own").alias("own"), F.coalesce(F.max(F.col("label").isNull()) | (F.min("label") != F.max("label")), F.lit(True)).alias("open"))
        stats = settled(stats)
        size = F.when(F.col("open"), F.col("n")).otherwise(0)
        parents = stats.groupBy("region").agg(F.sum("own").alias("n"), F.sum(size).alias("total"), F.max(size).alias("top")).where("total > 0")
        parents = parents.select("region", ((F.col("total") <= 2 * F.col("n")) & (F.col("top") <= 0.75 * F.col("n"))).alias("parted"))
        verdict = sized(stats.join(parents, "region").select("child", "n", "parted", "open"))
        marked = cells.join(verdict, "child")
        kids = marked.where("parted and open")
        links.append(_by_group(kids.where(F.col("n") <= block), sets, "child", percent))
        pairs.append(marked.where("own and not parted").select("region", "id", "label"))
        regions = settled(kids.where(F.col("n") > block).select(F.col("child").alias("region"), "id", "label"))
        if regions.isEmpty():
            break
    else:
        pairs.append(regions)
    links.append(_pairs_of_blocks(settled(_union(pairs)), sets, percent, block))
    return _union(links)


def late_bits(hashes: DataFrame, count: str) -> np.ndarray:
    """A bitmap of the low bits of frequent hashes; of too many, those of the highest counts."""
    level = F.floor(F.log2(count)).cast("int")
    steps = {r["k"]: r["n"] for r in hashes.groupBy(level.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}  # at most 63 rows
    least, total = 64, 0
    for k in sorted(steps, reverse=True):
        total += steps[k]
        if total > LATE_BITS // 8:
            break
        least = k
    bits = F.col("hash").bitwiseAND(LATE_BITS - 1)
    place = hashes.where(level >= least).select(F.shiftright(bits, 3).cast("int").alias("at"), F.expr("shiftleft(1, cast(hash & 7 as int))").alias("bit"))
    rows = place.groupBy("at").agg(F.expr("bit_or(bit)").alias("bits")).toArrow()  # at most LATE_BITS / 8 rows
    out = np.zeros(LATE_BITS // 8, np.uint8)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return out


def _regions(reps: DataFrame | None, cut: DataFrame, percent: int, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Regions (pivot, id) of the members, and the hashes that two of them share with their pivot and count."""
    dealt = cut.select("slice", "prefix").mapInArrow(frugal(_to_buckets(buckets)), "bucket int, slice string, keys binary, twice binary")
    shared = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(frugal(grouped("bucket", _shared)), "slice string, shared binary")
    lists = shared.groupBy("slice").agg(F.collect_list("shared").alias("shared"))
    some = cut.select("slice", "ids", "sizes", "lengths", "prefix").join(lists, "slice")
    found = some.mapInArrow(frugal(_survivors(percent, buckets)), "id long, size int, shared array<long>")
    found = found if reps is None else found.join(reps, "id", "left_semi")
    hashes = settled(found.select("id", "size", F.explode("shared").alias("hash")))
    del dealt, shared, lists, some, found
    release(cut.sparkSession)

    pivots = hashes.groupBy("hash").agg(F.min("id").alias("pivot"), F.max("id").alias("high"), F.count(F.lit(1)).alias("df")).where("pivot < high").select("hash", "pivot", "df")
    pivots = settled(pivots)  # so that a join with a hash that very many have can be split
    seen = hashes.join(pivots.select("hash", "pivot"), "hash").groupBy("id", "size", "pivot").agg(F.count(F.lit(1)).alias("c"))
    need = F.greatest(F.lit(1), F.floor(COMMON * F.floor((percent * F.col("size") + 99) / 100) / 100))
    farther = W.partitionBy("id").orderBy("c", F.desc("pivot")).rowsBetween(W.unboundedPreceding, 0)
    seen = seen.withColumn("left_out", F.sum("c").over(farther))
    # Of the k common hashes each of two linked members leaves out fewer than half.
    return settled(seen.where(F.col("left_out") > F.floor((need - 1) / 2)).select("pivot", "id")), pivots


def jaccard_links(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK, broadcast_ids: int = BROADCAST_IDS
) -> tuple[DataFrame, DataFrame]:
    """Members (id, size, rep: the least id with the same set) and links (a, b) between
    representatives: a spanning forest of the verified links, from which the components follow.

    Ids are expected to be there and to differ (see ``keyed``).
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    cut = settled(texts.mapInArrow(frugal(_prefixes(width, percent, None)), SLICES))
    fields = F.explode(F.arrays_zip("ids", "sizes", "sums", "marks")).alias("x")
    every = cut.select(fields).select(F.col("x.ids").alias("id"), F.col("x.sizes").alias("size"), F.col("x.sums").alias("s"), F.col("x.marks").alias("m"))
    classes = settled(every.where("size > 0").groupBy("size", "s", "m").agg(F.min("id").alias("rep")))  # so that the join with a set that very many have can be split
    members = every.join(classes, ["size", "s", "m"], "left").select("id", "size", F.coalesce("rep", "id").alias("rep"))

    own, reps, late, before, links, buckets = texts, classes.select(F.col("rep").alias("id")), None, None, [], 2 * partitions(docs.sparkSession)
    for level in range(LEVELS):
        regions, pivots = _regions(reps, cut, percent, buckets)
        sizes = regions.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        large = sized(sizes.where(F.col("n") > block).select("pivot", F.lit(True).alias("large")), broadcast_ids)
        marked = regions.join(large, "pivot", "left")
        small = marked.where("large is null").join(sizes.where(F.col("n") <= block).select("pivot"), "pivot").select("pivot", "id")
        rest = settled(marked.where("large").select("pivot", "id"))
        ids = rest.select("id").distinct()
        count = ids.count()
        release(docs.sparkSession)
        # Regions that another order does not make smaller are divided by metric.
        last = not count or level + 1 == LEVELS or (before is not None and count > SHRINK * before)
        wanted = small.select("id")
        if last and count:
            wanted = wanted.unionByName(rest.select("id"))
        sets = settled(own.join(sized(wanted.distinct(), broadcast_ids), "id", "left_semi").mapInArrow(frugal(_sets(width)), "id long, hashes binary"))
        links.append(_by_group(small, sets, "pivot", percent))
        if last:
            if count:
                links.append(_divided(rest.select(F.col("pivot").cast("string").alias("region"), "id", F.lit(None).cast("long").alias("label")), sets, percent, block))
            break
        frequent = late_bits(pivots.where(F.col("df") > min(32, block)).join(large, "pivot").select("hash", "df"), "df")
        late = frequent if late is None else late | frequent
        parts = min(4 * partitions(docs.sparkSession), -(-count // LEVEL_ROWS))
        own, reps, before = settled(own.join(sized(ids, broadcast_ids), "id", "left_semi").repartition(parts)), None, count
        cut = settled(own.mapInArrow(frugal(_prefixes(width, percent, late)), SLICES))
        hashes = cut.agg(F.sum(F.octet_length("prefix"))).first()[0] // 8
        buckets = max(1, min(2 * partitions(docs.sparkSession), hashes // BUCKET))
    return members, _union(links)


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """One row per document: id, n_shingles, component_id."""
    return _components(docs, id_col, text_col, width, percent, block, broadcast_ids)[0].select(F.col("id").alias(id_col), F.col("size").cast("long").alias("n_shingles"), "component_id")


def _components(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, block: int, broadcast_ids: int) -> tuple[DataFrame, bool]:
    """One row per document: key (see ``keyed``), id, size, root (a key) and component_id, and whether any key is no id."""
    rows, odd = keyed(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "id", F.col("text"))
    members, links = jaccard_links(rows.select("__key", "text"), "__key", "text", width, percent, block, broadcast_ids)
    roots = components(links).select(F.col("node").alias("rep"), "component")
    out = members.join(roots, "rep", "left").select(F.col("id").alias("key"), "size", F.coalesce("component", "rep").alias("root"))
    if not odd:
        return out.select("key", F.col("key").alias("id"), "size", "root", F.col("root").alias("component_id")), False
    names = sized(rows.where("not (__key <=> id)").select(F.col("__key").alias("key"), F.col("id").alias("own"), F.lit(True).alias("other")).distinct(), broadcast_ids)
    out = settled(out.join(names, "key", "left").select("key", F.when(F.col("other"), F.col("own")).otherwise(F.col("key")).alias("id"), "size", "root"))
    return out.join(out.groupBy("root").agg(F.min("id").alias("component_id")), "root"), True


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of each component the document with the least id, with all its columns."""
    rows, odd = _components(docs, id_col, text_col, SHINGLE, PERCENT, BLOCK, BROADCAST_IDS)
    if not odd:
        gone = sized(rows.where("component_id <> id").select(F.col("id").alias("__gone_id")))
        return docs.join(gone, docs[id_col] == gone["__gone_id"], "left_anti")
    # Keys tell rows apart; of a component the row stays that has the least id, then the least key.
    marked, _ = keyed(docs, id_col, F.col(text_col))
    best = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("best"))
    stays = rows.join(best, "root").where("key = best.key").groupBy("key").agg(F.count(F.lit(1)).alias("__rows"))
    marked = marked.join(settled(stays).withColumnRenamed("key", "__key"), "__key")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = marked.where("__rows > 1").groupBy("__key").agg(F.any_value(whole).alias("__row")).select("__row.*")
    return marked.where("__rows = 1").select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(one)
