"""Similarity by longest matching blocks: guarded merging of works, identity checks, and one-to-one matching.

The ratio is that of difflib, whose arguments' order counts; it runs over Arrow batches
of pairs that equi-joins have made, or in groups of what is left after equal rows met.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import sequence_ratio
from ..sources.tables import settled
from .components import connected, group_edges

#: Ratios that titles of one component, of a candidate pair, and of a registry's answer must reach.
TITLE_RATIO, CANDIDATE_RATIO, IDENTITY_RATIO = 0.85, 0.97, 0.98
#: Members beyond which a title's group goes to review and makes no edge.
MAX_GROUP = 250


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def generic(title: str) -> bool:
    return len(title) < 20 or sum(len(t) > 2 for t in title.split()) < 4


class WorkForest:
    """Components of occurrences with what their members say; the least id is the root."""

    def __init__(self, nodes: dict):
        self.root = {k: k for k in nodes}
        self.titles = {k: {n["title"]} for k, n in nodes.items()}
        self.years = {k: set() if n["year"] is None else {n["year"]} for k, n in nodes.items()}
        self.families = {k: set() if n["family"] == "unknown" else {n["family"]} for k, n in nodes.items()}
        self.dois = {k: set(n["dois"]) for k, n in nodes.items()}
        self.isbns = {k: set(n["isbns"]) for k, n in nodes.items()}

    def find(self, x):
        while self.root[x] != x:
            self.root[x] = x = self.root[self.root[x]]
        return x

    def _drift(self, a, b) -> bool:
        return any(ratio(x, y) < TITLE_RATIO for x in self.titles[a] for y in self.titles[b])

    def conflict(self, a, b, by_doi: bool) -> str | None:
        """Why two components must stay apart, or None."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return None
        years, families, prefix = self.years[a] | self.years[b], self.families[a] | self.families[b], "doi_" if by_doi else ""
        if years and max(years) - min(years) > (1 if by_doi else 0):
            return prefix + "year_conflict"
        if len(families) > 1:
            return prefix + "type_conflict"
        if not by_doi and self.dois[a] and self.dois[b] and not self.dois[a] & self.dois[b]:
            return "doi_conflict"
        if not by_doi and families == {"book"} and self.isbns[a] and self.isbns[b] and not self.isbns[a] & self.isbns[b]:
            return "isbn_conflict"
        return ("doi_title_conflict" if by_doi else "transitive_title_drift") if self._drift(a, b) else None

    def merge(self, a, b) -> None:
        a, b = sorted((self.find(a), self.find(b)))
        if a != b:
            self.root[b] = a
            for own in (self.titles, self.years, self.families, self.dois, self.isbns):
                own[a] |= own.pop(b)


def shared_names(a: dict, b: dict) -> bool:
    """Two occurrences name a person in common; within one profile only advised people count."""
    if a["profile"] is not None and a["profile"] == b["profile"]:
        return bool(set(a["advised"]) & set(b["advised"]))
    one, two = ({*n["names"], *n["advised"]} for n in (a, b))
    return bool(one & two) or (a["owner"] or None) in two or (b["owner"] or None) in one


def replay(nodes: dict, groups: list[tuple[str, str, list]]) -> tuple[dict, list[tuple]]:
    """Merges in a fixed order: DOI groups, then groups of one title and year; members by id.

    Returns each node's root, and rows (kind, left, right, reason): edges and what goes to review.
    """
    forest, rows = WorkForest(nodes), []
    for kind, key, members in sorted(groups):
        anchors: dict[str, list] = {}
        for m in members:
            own = anchors.setdefault("" if kind == "doi" else nodes[m]["family"], [])
            takes, first = [], None
            for a in own:
                why = None
                if kind == "title":
                    x, y = nodes[a], nodes[m]
                    names, isbn = shared_names(x, y), bool(set(x["isbns"]) & set(y["isbns"]))
                    book = y["family"] == "book"
                    if generic(y["title"]) and not (names or (book and isbn)):
                        why = "generic_title_without_author_evidence"
                    elif book and not isbn and not names:
                        why = "book_title_without_isbn_or_author_evidence"
                why = why or forest.conflict(a, m, kind == "doi")
                if why is None:
                    takes.append(a)
                    if kind == "doi":
                        break
                elif first is None:
                    first = (a, why)
            if not takes:
                if first:
                    rows.append(("review", *((m, first[0]) if kind == "doi" else (first[0], m)), first[1]))
                own.append(m)
            for a in takes:
                if forest.conflict(a, m, kind == "doi") is None:
                    rows.append(("edge", a, m, key))
                    forest.merge(a, m)
        heads = [own[0] for _, own in sorted(anchors.items()) if own]
        rows += [("review", heads[0], other, "type_conflict") for other in heads[1:]]
    return {k: forest.find(k) for k in nodes}, rows


NODE = ["id", "title", "year", "family", "dois", "isbns", "owner", "profile", "names", "advised"]


def work_components(nodes: DataFrame, most: int = MAX_GROUP) -> tuple[DataFrame, DataFrame]:
    """Components of occurrences (id, root), and evidence (kind: edge, review or oversized; left_id, right_id, reason).

    ``nodes`` has the columns of ``NODE``; dois are those that identify a work.  Merges only
    happen within groups of one DOI, or of one title and year; what the groups connect
    without guards is replayed by itself.  Occurrences with a DOI that agree in all but
    their id merge in any case and count as one, so that copies do not meet in one task.
    """
    content = [c for c in NODE if c != "id"]
    normal = nodes.select("id", *[F.sort_array(F.array_distinct(c)).alias(c) if c in ("dois", "isbns", "names", "advised") else F.col(c) for c in content])
    normal = settled(normal.withColumn("alone", F.when(F.size("dois") == 0, F.col("id"))))
    classes = normal.groupBy(*content, "alone").agg(F.min("id").alias("id"))
    by_title = F.when(F.col("year").isNotNull() & (F.col("title") != ""), F.array(F.struct(F.lit("title").alias("kind"), F.format_string("%06d|%s", "year", "title").alias("key"))))
    by_doi = F.transform("dois", lambda x: F.struct(F.lit("doi").alias("kind"), x.alias("key")))
    keys = F.array_union(F.coalesce(by_title, F.array().cast("array<struct<kind:string,key:string>>")), by_doi)
    each = normal.select("id", F.explode(keys).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    large = each.where((F.col("k.kind") == "title") & (F.col("n") > most))
    oversized = large.select(F.lit("oversized").alias("kind"), F.col("least").alias("left_id"), F.lit(None).cast(dict(nodes.dtypes)["id"]).alias("right_id"), F.col("k.key").alias("reason"))
    good = each.where((F.col("n") > 1) & ((F.col("k.kind") == "doi") | (F.col("n") <= most))).select("k")
    classes = settled(classes)
    member = settled(classes.select("id", F.explode(keys).alias("k")).join(good, "k"))
    coarse = connected(group_edges(member, "id", "k")).select(F.col("node").alias("id"), F.col("component").alias("coarse"))
    rows = classes.join(coarse, "id").join(member.groupBy("id").agg(F.collect_list("k").alias("keys")), "id")
    kind = dict(nodes.dtypes)["id"]

    def solve(part: pd.DataFrame) -> pd.DataFrame:
        blank = lambda x: [] if x is None else list(x)
        own = {r["id"]: {**r, "year": None if pd.isna(r["year"]) else int(r["year"]), **{c: blank(r[c]) for c in ("dois", "isbns", "names", "advised")}} for r in part.to_dict("records")}
        groups: dict[tuple, list] = {}
        for i in sorted(own):
            for k in own[i]["keys"]:
                groups.setdefault((k["kind"], k["key"]), []).append(i)
        roots, found = replay(own, [(*k, v) for k, v in groups.items() if len(v) > 1])
        out = [("member", i, r, None) for i, r in roots.items()] + found
        return pd.DataFrame(out, columns=["kind", "left_id", "right_id", "reason"])

    found = settled(rows.groupBy("coarse").applyInPandas(solve, f"kind string, left_id {kind}, right_id {kind}, reason string"))
    roots = found.where("kind = 'member'").select(F.col("left_id").alias("rep"), F.col("right_id").alias("root"))
    same = None
    for c in [*content, "alone"]:
        one = F.col(f"n.{c}").eqNullSafe(F.col(f"c.{c}"))
        same = one if same is None else same & one
    reps = normal.alias("n").join(classes.withColumnRenamed("id", "rep").alias("c"), same).select(F.col("n.id").alias("id"), F.col("c.rep").alias("rep"))
    members = reps.join(roots, "rep", "left").select("id", F.coalesce("root", "rep").alias("root"))
    return members, found.where("kind <> 'member'").unionByName(oversized)


def identity_match(rows: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """title_score, year_match, type_match and confirmed of rows (key, title, year, family) against a registry's
    answers (key, titles, years, family).
    """
    other = answers.select(F.col(key).alias("__k"), F.explode_outer("titles").alias("__t"), F.col("years").alias("__y"), F.col("family").alias("__f"))
    joined = rows.join(other, rows[key] == other["__k"], "left")
    scored = joined.withColumn("__s", F.coalesce(sequence_ratio(F.col("title"), F.col("__t")), F.lit(0.0)))
    out = scored.groupBy(key, "title", "year", "family").agg(F.max("__s").alias("score"), F.first("__y").alias("__y"), F.first("__f").alias("__f"))
    year = F.coalesce(F.array_contains("__y", F.col("year")), F.lit(False))
    kind = F.coalesce(F.col("__f") == F.col("family"), F.lit(False))
    return out.select(key, F.round("score", 6).alias("title_score"), year.alias("year_match"), kind.alias("type_match"), ((F.col("score") >= IDENTITY_RATIO) & year & kind).alias("confirmed"))


def match_score(old: dict, new: dict) -> float:
    """How surely a record is another version of one: 1 if title and year are equal, 0 if nothing speaks for it."""
    a, b = old["title"], new["title"]
    if min(len(a), len(b)) < 5:
        return 0.0
    if a == b and old["year"] == new["year"]:
        return 1.0
    if old["kind"] != new["kind"]:
        return 0.0
    dois, isbns = (bool(set(old[f]) & set(new[f])) for f in ("dois", "isbns"))
    near = old["year"] == new["year"] or (old["year"] is not None and new["year"] is not None and abs(old["year"] - new["year"]) <= 1)
    if a == b:
        return 1.0 if dois else 0.995 if isbns else 0.99
    least = 0.65 if dois else 0.8 if isbns else 0.94 if near else 2
    if least > 1 or SequenceMatcher(None, a, b).quick_ratio() < least:  # never below the ratio
        return 0.0
    likeness = ratio(a, b)
    if dois and likeness >= 0.65:
        return 1.0
    if isbns and likeness >= 0.8:
        return 0.995
    return likeness if near and likeness >= 0.94 else 0.0


def best_pairs(old: list[dict], new: list[dict]) -> list[tuple[int, int, float]]:
    """Greedy one-to-one pairs by falling score, ties by the later places."""
    scores = sorted(((s, i, j) for i, a in enumerate(old) for j, b in enumerate(new) if (s := match_score(a, b))), reverse=True)
    out, left, right = [], set(), set()
    for s, i, j in scores:
        if i not in left and j not in right:
            left.add(i)
            right.add(j)
            out.append((i, j, s))
    return out


def compare_records(old: DataFrame, new: DataFrame, owner: str, fingerprint: Column) -> DataFrame:
    """unchanged, modified, added and removed records of each owner.

    Both sides have the owner, title, year, kind, dois and isbns.  Equal fingerprints cancel
    out by counts first; only what is left of an owner's records is matched one to one.
    """
    fields = ["title", "year", "kind", "dois", "isbns"]
    side = lambda df, d: df.select(owner, fingerprint.alias("fp"), *fields, F.lit(d).alias("d"))
    both = side(old, 1).unionByName(side(new, -1))
    counts = both.groupBy(owner, "fp").agg(F.sum(F.when(F.col("d") > 0, 1).otherwise(0)).alias("o"), F.sum(F.when(F.col("d") < 0, 1).otherwise(0)).alias("n"), *[F.any_value(F.struct(*fields)).alias("r")])
    same = counts.groupBy(owner).agg(F.sum(F.least("o", "n")).alias("unchanged"), F.sum("o").alias("old_count"), F.sum("n").alias("new_count"))
    rest = counts.where("o <> n").select(owner, "fp", (F.col("o") - F.col("n")).alias("d"), "r.*")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = []
            for records in batch.column("records"):
                rows = [{**r, "dois": r["dois"] or [], "isbns": r["isbns"] or []} for r in records.as_py()]
                many = lambda sign: [r for r in rows for _ in range(max(0, sign * r["d"]))]  # noqa: E731, B023
                a, b = many(1), many(-1)
                counts.append((len(best_pairs(a, b)), len(a), len(b)))
            columns = zip(*counts) if counts else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(owner), *(pa.array(c, pa.int64()) for c in columns)], [owner, "modified", "left_over", "fresh"])

    kind = dict(old.dtypes)[owner]
    listed = rest.groupBy(owner).agg(F.sort_array(F.collect_list(F.struct("fp", "d", *fields))).alias("records"))
    matched = listed.mapInArrow(solve, f"{owner} {kind}, modified long, left_over long, fresh long")
    out = same.join(matched, owner, "left")
    n = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return out.select(owner, "old_count", "new_count", "unchanged", n("modified").alias("modified"), (n("left_over") - n("modified")).alias("removed"), (n("fresh") - n("modified")).alias("added"))


def titled_pairs(pairs: DataFrame, left: str, right: str, least: float = CANDIDATE_RATIO) -> DataFrame:
    """Pairs whose titles reach a ratio, over Arrow batches."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield part[[a is not None and b is not None and ratio(a, b) >= least for a, b in zip(part[left], part[right])]]

    return pairs.mapInPandas(run, pairs.schema)
