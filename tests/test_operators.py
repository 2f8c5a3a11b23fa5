"""Operators, sources and increments on small literal tables."""

import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cordillera.operators import aggregates, audits, blocking, cohorts, components, entities, linkage, matching, merge, occurrences, reconcile, routing
from cordillera.plans import runs
from cordillera.sources import acquisition, pages, publication, records, tables
from cordillera.streaming import incremental


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def test_link_outcomes(spark):
    side = "t string, y int, owners array<int>, groups array<int>"
    products = spark.createDataFrame([("p1", "a", 1, [1], [9]), ("p2", "a", 1, [7], [7]), ("p3", "z", 1, [1], [1]), ("p4", "b", 1, [1], [1]), ("p5", "c", 1, [1], [1])], "product_id string, " + side)
    graph = spark.createDataFrame(
        [("e1", "a", 1, [1], [9]), ("e2", "a", 1, [2], [8]), ("e3", "b", 1, [1], [5]), ("e4", "b", 1, [1], [6])] + [(f"x{k}", "c", 1, [1], [1]) for k in range(4)],
        "entity_id string, t string, y int, eo array<int>, eg array<int>",
    )
    out = linkage.link(products, graph, ["t", "y"], ("owners", "eo"), ("groups", "eg"), 3)
    assert rows(out, "product_id", "status", "candidate_count", "entity_id", "rule") == [
        ("p1", "linked", 2, "e1", "owner_group"),
        ("p2", "ambiguous", 2, None, None),
        ("p3", "unlinked", 0, None, None),
        ("p4", "ambiguous", 2, None, None),
        ("p5", "ambiguous", 4, None, None),
    ]
    strict = linkage.link(products, graph, ["t", "y"], ("owners", "eo"), ("groups", "eg"), 3, F.col("t") == "b")
    assert [r for r in rows(strict, "product_id", "status") if r[0] == "p4"] == [("p4", "ambiguous")]


def test_bracketing_never_extrapolates(spark):
    facts = spark.createDataFrame([("g", 2000, "A"), ("g", 2004, "A"), ("g", 2008, "B")], "g string, y int, v string")
    targets = spark.createDataFrame([("g", y) for y in (1999, 2000, 2002, 2006, 2008, 2010)], "g string, year int")
    got = linkage.bracketing(targets, facts, "g", "year", "y", "v")
    assert rows(got, "year", "v") == [(1999, None), (2000, "A"), (2002, "A"), (2006, None), (2008, "B"), (2010, None)]


def test_components_and_guards(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(k, k + 1) for k in range(200, 240)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = components.connected(spark.createDataFrame(edges, "a long, b long"))
    assert rows(got) == sorted((x, find(x)) for x in parent)

    members = [(m, f"k{rng.randrange(40)}", float(rng.randrange(12))) for m in range(80)]
    forest = components.SpreadForest({m: v for m, _, v in members}, 4.0)
    for _, own in itertools.groupby(sorted(members, key=lambda r: (r[1], r[0])), key=lambda r: r[1]):
        anchors = []
        for m, _, _ in own:
            if not any(forest.merge(a, m) for a in anchors):
                anchors.append(m)
    out = components.spread_guarded(spark.createDataFrame(members, "m long, k string, v double"), "m", "k", "v", 4.0)
    assert rows(out) == sorted((m, forest.find(m)) for m, _, _ in members)


def test_blocking(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, "")], "i int, k string")
    assert rows(blocking.exact_blocks(df, F.col("k"), "i")) == [("x", 2, 1, 2)]
    keys = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, ["a"]), (4, ["b"])], "i int, ks array<string>")
    assert rows(blocking.block_pairs(keys, "i", F.col("ks"), 2)) == [(1, 4)]
    words = spark.createDataFrame([(["delta", "al", "gamma", "beta", "gamma"],)], "t array<string>")
    assert words.select(blocking.token_pair_keys(F.col("t"))).first()[0] == ["beta delta", "beta gamma", "delta gamma"]


def test_consensus_and_history(spark):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("b", "x"), ("b", "y"), ("c", None)], "k string, v string")
    assert rows(aggregates.consensus(df, ["k"], "v"), "k", "status") == [("a", "consistent"), ("b", "conflict"), ("c", "missing")]
    assert rows(aggregates.mode_by(spark.createDataFrame([("a", 3), ("a", 2), ("a", 2), ("a", 3), ("b", 9)], "k string, y int"), ["k"], "y")) == [("a", 2, 2), ("b", 9, 1)]
    past = spark.createDataFrame([("g", 2001, 1, "A"), ("g", 2003, 2, ""), ("g", 2002, 3, "B")], "g string, y int, n int, cat string")
    assert rows(aggregates.history(past, "g", "y", "n", ["cat"])) == [("g", 3, 2001, 2003, "B")]
    two = aggregates.fingerprint(past, ["y", "n"]).first(), aggregates.fingerprint(past.orderBy("n", ascending=False), ["n", "y"]).first()
    assert two[0] == two[1]


def test_roles_and_aliases(spark):
    df = spark.createDataFrame([(1, "k", "advisor"), (1, "k", "student"), (2, "k", "other")], "g int, k string, role string")
    assert rows(merge.role_precedence(df, "g", F.col("k"), "role", ["student", "advisor"]), "g", "role") == [(1, "student"), (2, "other")]
    names = spark.createDataFrame([(1, "ana ruiz"), (1, "ana maria ruiz"), (1, "luis"), (2, "ana ruiz"), (2, "ana b ruiz"), (2, "ana c ruiz")], "g int, n string")
    assert rows(merge.superset_alias(names, "g", "n")) == [(1, "ana ruiz", "ana maria ruiz")]
    a = spark.createDataFrame([(1, "ab", 5), (2, "x", None)], "k int, t string, n int")
    b = spark.createDataFrame([(1, "abc", 6), (3, "z", 7)], "k int, t string, n int")
    assert rows(merge.merge_scalars(a, b, "k", ["t"], ["n"]).na.fill(0)) == [(1, "abc", 5), (2, "x", 0), (3, "z", 7)]


def test_routing(spark):
    catalogue = spark.createDataFrame([("Libro", True, "work", "Book"), ("libro", False, "work", "Other"), ("Obra", True, "work", "A"), ("Obra", True, "project", "B"), ("Vacío", True, None, None)], "label string, leaf boolean, entity string, kind string")
    inherited = routing.inherit(catalogue, "label", "leaf", ["entity", "kind"])
    assert rows(inherited, "key", "status", "kind") == [("libro", "resolved", "Book"), ("obra", "ambiguous", None), ("vacío", "pending", None)]
    reviewed = spark.createDataFrame([("obra", "project", "B")], "key string, entity string, kind string")
    assert rows(routing.resolve(inherited, reviewed, ["entity", "kind"]), "key", "status") == [("libro", "resolved"), ("obra", "reviewed"), ("vacío", "pending")]
    df = spark.createDataFrame([("a", "work"), ("a", "work"), ("b", "work"), ("b", "event"), ("c", None), ("c", "work")], "k string, e string")
    assert rows(routing.target_entity(df, "k", "e")) == [("a", "work"), ("b", "mixed"), ("c", "unmapped")]


def test_audits(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "k int, s string, n int")
    new = spark.createDataFrame([(1, "a", 1), (2, "x", None), (4, "d", 4)], "k int, s string, n int")
    assert rows(audits.snapshot_diff(old, new, "k", ["s", "n"])) == [("added", "", 1), ("changed", "s,n", 1), ("removed", "", 1), ("unchanged", "", 1)]
    assert rows(audits.same_rows(old, new, "k")) == [(3, "left"), (4, "right")]
    assert rows(audits.coverage(old, new, "k", ("s", "s"))) == [("covered", 1), ("mismatch", 1), ("missing", 1), ("unexpected", 1)]
    found = audits.findings(old, "k", {"odd": F.col("n") % 2 == 1, "b": F.col("s") == "b"})
    assert rows(found) == [(1, "odd"), (2, "b"), (3, "odd")]
    assert rows(audits.bounded_examples(found, 1), "kind", "id") == [("b", 2), ("odd", 1)]
    assert audits.gate(audits.finding_counts(found), "n", F.col("kind") == "none") and not audits.gate(audits.finding_counts(found), "n", F.col("kind") == "odd")


PAGE = """<html lang="es"><head><title>A &amp; B</title><style>x</style></head><body><h1>Head <b>one</h1>
<a href="/x">x</a><table><tr><td>a <i>b</i><td>c</td></tr><tr><th>d</th></table><i>Label:</i> value &eacute; <script>var a="</p>";</script><a href='y'>"""


def test_pages(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "page_id long, html string")
    out = {r["id"]: r for r in pages.page_facts(df, "page_id", "html").collect()}
    one = out[1]
    assert (one["title"], one["heading"], one["lang"], one["links"]) == ("A & B", "Head one", "es", ["/x", "y"])
    assert one["fields"] == {"Label": "value é"} and one["cells"][-1] == ["d"] and out[2]["title"] == ""
    status = pages.page_status(F.col("html"), ["<body>"], "private")
    assert [r[0] for r in df.orderBy("page_id").select(status).collect()] == ["downloaded", "empty", "empty"]
    raw = spark.createDataFrame([("<meta charset=iso-8859-1>é".encode("latin-1"),), (b"caf\xc3\xa9",)], "b binary")
    assert [tuple(r[0]) for r in raw.select(pages.decoded(F.col("b"))).collect()] == [("<meta charset=iso-8859-1>é", 0), ("café", 0)]


def test_publication(spark, tmp_path):
    df = spark.range(5)
    with pytest.raises(ValueError):
        publication.publish_table(df, f"file://{tmp_path}", "t", 4)
    publication.publish_table(df, f"file://{tmp_path}", "t", 5)
    with pytest.raises(FileExistsError):
        publication.publish_table(df, f"file://{tmp_path}", "t")
    pointer = publication.Pointer(spark, f"file://{tmp_path}/current.json")
    one, two = {"version": 1, "date": "20240101"}, {"version": 2, "date": "20240101"}
    pointer.publish(one, None)
    pointer.publish(two, one)
    assert pointer.read() == two
    with pytest.raises(RuntimeError):
        pointer.publish({"version": 3, "date": "20240101"}, one)
    with pytest.raises(ValueError):
        pointer.publish(one, two)
    assert publication.published_name("reg", "works", 3, "20240101", True) == "reg_works_v03_20240101_filtered"


def test_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2}]')
    assert rows(tables.json_array(spark, str(tmp_path / "a.json"), "a int")) == [(1,), (2,)]
    (tmp_path / "b.json").write_text('[{"a": "x"}]')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        tables.json_array(spark, str(tmp_path / "b.json"), "a int").collect()
    (tmp_path / "c.csv").write_text("a,b\n1,x\n")
    assert rows(tables.csv_table(spark, str(tmp_path / "c.csv"), "a int, b string")) == [(1, "x")]
    ids = tables.row_ids(spark.range(50).repartition(5), "set", "id")
    assert rows(ids, "id", "_id") == [(k, f"set:{k:010d}") for k in range(50)]


def test_increments(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/in/a")
    for n in (3, 5):
        incremental.resumable_load(spark, f"{tmp_path}/in/*", spark.range(1).schema, f"{tmp_path}/out", f"{tmp_path}/mark").awaitTermination(120)
        assert spark.read.parquet(f"{tmp_path}/out").count() == n
        if n == 3:
            spark.range(2).write.parquet(f"{tmp_path}/in/b")
    states = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("j", 1, "c")], "k string, t int, s string")
    assert rows(incremental.latest(states, "k", ["t"])) == [("j", 1, "c"), ("k", 2, "b")]
    assert rows(incremental.changed(states, states.where("t = 1"), ["k", "t"])) == [("k", 2, "b")]


def test_identity_ladder_and_shapes(spark):
    df = spark.createDataFrame([(1, "t", 2020), (2, "t", 2020), (3, "t", None), (4, None, None)], "i int, t string, y int")
    key, rule = entities.identity([("title_year", [F.col("t"), F.col("y")])], [F.col("i")])
    got = {r["i"]: (r["k"], r["rule"]) for r in df.select("i", key.alias("k"), rule.alias("rule")).collect()}
    assert got[1] == got[2] and got[1][1] == "title_year" and got[3][1] == got[4][1] == "source" and got[3][0] != got[4][0]
    schema = T.StructType([T.StructField("i", T.LongType()), T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("t", T.StringType())])
    assert rows(entities.complete_shape(df.select("i", F.col("t").alias("tags"), "t"), schema)) == [(1, [], "t"), (2, [], "t"), (3, [], "t"), (4, [], "")]


def test_constraints_hold_over_whole_components(spark):
    df = spark.createDataFrame([(1, "k", "CO"), (2, "k", None), (3, "k", "PE"), (2, "j", None), (4, "j", "PE"), (5, "j", "CO")], "m int, k string, c string")
    got = dict(rows(entities.constraint_components(df, "m", "k", ["c"])))
    values = {1: "CO", 3: "PE", 4: "PE", 5: "CO"}
    for a, b in itertools.combinations(values, 2):
        assert got[a] != got[b] or values[a] == values[b]
    ids = spark.createDataFrame([("a", 1, 0), ("b", 2, 0), ("b", 3, 0), ("c", 4, 1), ("c", 5, 2)], "c string, m int, p int")
    canonical = {r["c"]: r["canonical_id"] for r in entities.canonical_ids(ids, "c", "m", "p").collect()}
    assert canonical["a"] == "1" and len(canonical["b"]) == 64 and canonical["c"] == "5"


def test_reconciliation(spark):
    values = spark.createDataFrame([("10.1", x) for x in ("journal.2020.12", "journal.2020", "journal.2021.12", "other.9")], "p string, s string")
    pairs = reconcile.similar_pairs(values, "p", "s")
    assert rows(pairs, "left_suffix", "right_suffix", "how") == [("journal.2020", "journal.2020.12", "truncation"), ("journal.2020.12", "journal.2021.12", "edit")]
    checks = spark.createDataFrame([("journal.2020", "rejected"), ("journal.2020.12", "verified"), ("journal.2021.12", "verified")], "s string, st string")
    decided = reconcile.decisions(pairs, checks, "left_suffix", "right_suffix", "s", "st")
    assert rows(decided, "decision") == [("confirmed_correction",), ("review",)]
    docs = spark.createDataFrame([(1, ["x", "journal.2020", "journal.2020.12"]), (2, ["y"])], "i int, v array<string>")
    assert rows(reconcile.apply_corrections(docs, "i", "v", reconcile.corrections(decided)), "i", "v") == [(1, ["x", "journal.2020.12"]), (2, ["y"])]


def test_cohorts(spark):
    priority, reference = spark.range(40).withColumnRenamed("id", "code"), spark.range(20, 60).withColumnRenamed("id", "code")
    got = rows(cohorts.cohort(priority, reference, 5, "s"), "segment", "code")
    assert [s for s, _ in got] == ["new"] * 5 + ["refresh"] * 5 and all((c < 20) == (s == "new") for s, c in got)
    union = cohorts.ordered_union([(priority, F.col("code")), (reference, F.col("code"))])
    assert {r["code"]: r["rank"] for r in union.collect()} == {c: int(c >= 40) for c in range(60)}


def test_runs_resume(spark, tmp_path):
    calls = []

    def stage(name, fail=False):
        def act(session, done):
            calls.append(name)
            if fail and calls.count(name) == 1:
                raise ValueError("first time")
            return session.range(3) if not done else done["one"].withColumn("x", F.lit(name))

        return act

    run = runs.Run(spark, f"file://{tmp_path}/run", [("one", stage("one")), ("two", stage("two", fail=True))], {"two": lambda df: df.count() == 3})
    with pytest.raises(ValueError):
        run.execute()
    assert run.plan() == [("one", "complete"), ("two", "failed")]
    assert run.execute().count() == 3 and calls == ["one", "two", "two"] and run.plan()[1][1] == "complete"
    store = runs.Store(spark, f"file://{tmp_path}/locks")
    with runs.Lease(store, "l", 60):
        with pytest.raises(RuntimeError):
            runs.Lease(store, "l", 60).__enter__()
    with runs.Lease(store, "l", 60, now=lambda: 0), runs.Lease(store, "l", 60):
        pass
    assert runs.merged({"a": {"b": 1, "c": 2}, "d": 3}, {"a": {"b": 9}}) == {"a": {"b": 9, "c": 2}, "d": 3}
    with pytest.raises(KeyError):
        runs.merged({"a": 1}, {"z": 1})


def test_large_blocks_are_not_lost(spark):
    titles = [(k, "al bo " + "cy") for k in range(5)] + [(7, "one two"), (8, "two one"), (9, ""), (10, "solo"), (11, "solo"), (12, None)]
    df = spark.createDataFrame(titles, "i long, t string")
    out = blocking.block_pairs_or_members(df, "i", blocking.title_keys(F.col("t")), 3).collect()
    assert sorted((r.left_id, r.right_id) for r in out if r.kind == "pair") == [(7, 8), (10, 11)]
    large = {}
    for r in out:
        if r.kind == "oversized":
            large.setdefault((r.block, r["size"], r.left_id), []).append(r.right_id)
    assert {k: sorted(v) for k, v in large.items()} == {(b, 5, 0): [0, 1, 2, 3, 4] for b in ("p al bo", "p al cy", "p bo cy", "t al bo cy")}


def test_near_pairs_are_all_found(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(0, 9))) for _ in range(70)})

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, before = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
        return row[-1]

    df = spark.createDataFrame([(k % 2, w) for w in words for k in range(2)] + [(0, None)], "s int, w string")
    for edits in (1, 2, 3):
        want = {(a, b): distance(a, b) for a, b in itertools.combinations(words, 2) if distance(a, b) <= edits}
        got = reconcile.near_pairs(df, ["s"], "w", edits).collect()
        for scope in (0, 1):
            assert {(r["left_value"], r["right_value"]): r["distance"] for r in got if r["s"] == scope} == want


def test_works_merge_as_one_replay_would(spark):
    """Coarse components one by one against the whole table at once."""
    rng = random.Random(9)
    titles = ["estudio de la flora del norte andino", "estudio de la flora del norte andina", "notas", "historia de los caminos de hierro"]
    nodes = []
    for k in range(120):
        pick = lambda n, p: sorted({f"{n}{rng.randrange(6)}" for _ in range(2)}) if rng.random() < p else []
        nodes.append((f"n{k:03d}", rng.choice(titles), rng.choice([2019, 2020, 2020, 2021, None]), rng.choice(["article", "article", "book", "unknown"]), pick("d", 0.3), pick("i", 0.4), rng.choice(["", "ana"]), rng.choice([None, "p1"]), pick("a", 0.5), pick("v", 0.3)))
    nodes += [(f"z{k}", *nodes[3][1:4], ["d9"], *nodes[3][5:]) for k in range(4)]
    df = spark.createDataFrame(nodes, "id string, title string, year int, family string, dois array<string>, isbns array<string>, owner string, profile string, names array<string>, advised array<string>")
    own = {n[0]: dict(zip(matching.NODE, n)) for n in nodes}
    groups = {}
    for i, n in own.items():
        for x in n["dois"]:
            groups.setdefault(("doi", x), []).append(i)
        if n["year"] is not None:
            groups.setdefault(("title", f"{n['year']:06d}|{n['title']}"), []).append(i)
    want, _ = matching.replay(own, [(*k, sorted(v)) for k, v in groups.items() if len(v) > 1])
    members, evidence = matching.work_components(df)
    assert dict(rows(members)) == want and len(set(want.values())) < len(want)
    assert {r["kind"] for r in evidence.collect()} == {"edge", "review"}
    large = spark.createDataFrame([(f"m{k}", "una historia de los caminos", 2000, "article", [], [], "", None, [], []) for k in range(5)], df.schema)
    members, evidence = matching.work_components(large, most=4)
    assert all(r["id"] == r["root"] for r in members.collect()) and rows(evidence, "kind", "left_id") == [("oversized", "m0")]


def test_guards_on_the_table(spark):
    """The two guarded queries against one replay over all parts and customers."""
    from cordillera.queries import QUERIES

    def replay(members, merge):
        for _, own in itertools.groupby(sorted(members, key=lambda r: (r[1], r[0])), key=lambda r: r[1]):
            anchors = []
            for m, _ in own:
                if not any(merge(a, m) for a in anchors):
                    anchors.append(m)

    sf = "/root/testdata/sf0.001"
    parts = spark.read.parquet(f"{sf}/part.parquet").collect()
    forest = components.SpreadForest({r["p_partkey"]: float(r["p_size"]) for r in parts}, 5.0)
    replay([(r["p_partkey"], f"{r['p_name']}|{r['p_brand']}") for r in parts], forest.merge)
    assert dict(rows(QUERIES["guarded_components"](spark, sf))) == {r["p_partkey"]: forest.find(r["p_partkey"]) for r in parts}
    people = spark.read.parquet(f"{sf}/customer.parquet").withColumn("k", F.concat_ws("|", "c_mktsegment", F.round("c_acctbal", -2).cast("long").cast("string"))).collect()
    forest = entities.ConstraintForest({r["c_custkey"]: ({r["c_nationkey"]},) for r in people})
    replay([(r["c_custkey"], r["k"]) for r in people], forest.merge)
    assert dict(rows(QUERIES["constraint_components"](spark, sf))) == {r["c_custkey"]: forest.find(r["c_custkey"]) for r in people}


def test_pointers_and_leases_have_one_winner(spark, tmp_path):
    where = f"file://{tmp_path}/pointer"
    one, two = publication.Pointer(spark, where), publication.Pointer(spark, where)
    one.publish({"version": 1, "date": "1"}, None)
    (tmp_path / "pointer" / "00000002.taken").write_text("")
    with pytest.raises(RuntimeError, match="being moved"):
        two.publish({"version": 2, "date": "1"}, {"version": 1, "date": "1"})
    late = publication.Pointer(spark, where, stale=-1)
    late.publish({"version": 2, "date": "1"}, {"version": 1, "date": "1"})
    assert one.read() == {"version": 2, "date": "1"}
    store, clock = runs.Store(spark, f"file://{tmp_path}/leases"), [0.0]
    first = runs.Lease(store, "l", 10, now=lambda: clock[0]).__enter__()
    clock[0] = 5
    first.renew()
    clock[0] = 12
    with pytest.raises(RuntimeError):
        runs.Lease(store, "l", 10, now=lambda: clock[0]).__enter__()
    clock[0] = 20
    second = runs.Lease(store, "l", 10, now=lambda: clock[0]).__enter__()
    with pytest.raises(RuntimeError, match="taken over"):
        first.renew()
    second.__exit__()
    runs.Lease(store, "l", 10, now=lambda: clock[0]).__enter__()


def test_acquisition(spark):
    pauses = []
    limiter = acquisition.RateLimiter(2, now=lambda: 0.0, sleep=pauses.append)
    assert limiter.wait() == 0 and 0.5 <= limiter.wait() <= 0.55 and len(pauses) == 1
    calls = []

    def get(dataset, limit, offset):
        calls.append(offset)
        raise ConnectionError("no")

    with pytest.raises(ConnectionError):
        acquisition.fetch_page(get, "d", 10, 0, 3, sleep=lambda s: None)
    assert len(calls) == 3


def test_odd_pages(spark):
    page = "<h3>Articulos</h3><blockquote>too short</blockquote><td><b>x<tr><blockquote>A, \"A title that is long\" 1999, Palabras: a"
    df = spark.createDataFrame([("1", None), ("2", ""), ("3", page), ("4", "<table><tr><td>1.- x")], "id string, html string")
    got = {r["id"]: r for r in records.person_pages(df, "id", "html", {}).collect()}
    assert [len(got[k]["production"]) for k in "1234"] == [0, 0, 1, 0] and got["3"]["production"][0]["title"] == "A title that is long"
    assert [r["production"] for r in records.group_pages(df, "id", "html", {}).collect()] == [[], [], [], []]
    assert records.person_pages(df.limit(0), "id", "html", {}).collect() == []


def test_parsed_records_are_handed_on_in_slices(spark):
    import pandas as pd

    pages_ = ["x" * (records.SLICE // 2), None, "y" * records.SLICE, "", "z" * (3 * records.SLICE), "w"]
    frames = list(records.parsed_slices([pd.DataFrame({"key": list("abcdef"), "html": pages_})], "id", lambda i, page: {"n": len(page or "")}))
    assert [list(f["id"]) for f in frames] == [["a", "b", "c"], ["d", "e"], ["f"]]
    assert [n for f in frames for n in f["n"]] == [len(x or "") for x in pages_]
    page = "<h3>Articulos</h3><blockquote>Ana, \"Study {} of graphs\" . En: Colombia, 1999, " + "x" * 500_000 + "</blockquote>"
    df = spark.createDataFrame([(k, page.format(k)) for k in range(40)], "id long, html string").coalesce(1)
    out = records.person_pages(df, "id", "html", {})
    assert out.select("id", F.size("production").alias("n")).agg(F.count_distinct("id"), F.sum("n")).first()[:] == (40, 40)
    read = df.mapInPandas(lambda parts: (pd.DataFrame({"n": [p["html"].str.len().sum()]}) for p in parts), "n long")
    assert read.agg(F.max("n")).first()[0] <= 2 * records.BATCH_BYTES


def test_scanner_finds_what_its_plain_pattern_finds():
    import re

    from cordillera.sources.markup import Scanner

    marks = {"a": r"\btipo\s*:", "b": r"\bp[aá]gs?\.?\s*:?", "c": r"\b(?:ISBN|edici[oó]n)\s*:", "d": r"\bámbito\s*:"}
    for given in (marks, marks | {"e": r"x*\d"}, marks | {"f": r"(?:no|\bv)\."}, marks | {"g": r"[^a-z ]\s*en"}):
        plain = re.compile("|".join(f"(?P<{name}>{mark})" for name, mark in given.items()), re.I)
        rng = random.Random(5)
        for _ in range(300):
            text = "".join(rng.choice(["tipo", "TIPO ", ":", " ", "pags.", "PÁG", "isbn:", "Edición :", "Ámbito:", "xx3", "no.", "v.", "#en", "é", "ſ", "\n"]) for _ in range(12))
            assert [(m.span(), m.lastgroup) for m in Scanner(given).pattern.finditer(text)] == [(m.span(), m.lastgroup) for m in plain.finditer(text)]


def test_records_are_compared_without_a_group_of_python_for_each_owner(spark):
    """Scores are those of the plain rules, and the plan has no grouped Python."""

    def plain(old, new):
        a, b = old["title"], new["title"]
        if min(len(a), len(b)) < 5:
            return 0.0
        if a == b and old["year"] == new["year"]:
            return 1.0
        if old["kind"] != new["kind"]:
            return 0.0
        likeness = matching.ratio(a, b)
        shares = lambda f: bool(set(old[f]) & set(new[f]))
        if shares("dois") and likeness >= 0.65:
            return 1.0
        if shares("isbns") and likeness >= 0.8:
            return 0.995
        if a == b:
            return 0.99
        near = old["year"] == new["year"] or (old["year"] is not None and new["year"] is not None and abs(old["year"] - new["year"]) <= 1)
        return likeness if near and likeness >= 0.94 else 0.0

    rng = random.Random(3)
    some = lambda: {
        "title": "".join(rng.choice("ab") if rng.random() < 0.1 else c for c in rng.choice(["a study of graphs", "a study of graph", "on trees and rain", "abc"])),
        "year": rng.choice([None, 1999, 2000, 2005]), "kind": rng.choice("xxxy"), "dois": rng.choice([[], ["1"], ["2", "1"]]), "isbns": rng.choice([[], ["3"]]),
    }
    for _ in range(3000):
        a, b = some(), some()
        assert matching.match_score(a, b) == plain(a, b)
    kind = "owner long, title string, year int, kind string, dois array<string>, isbns array<string>"
    old = spark.createDataFrame([(1, "a study of graphs", 1999, "x", [], []), (1, "a study of graphs", 1999, "x", [], []), (1, "on trees and rain", 2001, "x", None, None), (2, "same title", None, "x", [], [])], kind)
    new = spark.createDataFrame([(1, "a study of graphs", 2000, "x", [], []), (1, "a study of graphs", 1999, "x", [], []), (2, "same title", None, "x", [], []), (3, "new one", 1, "x", ["9"], [])], kind)
    out = matching.compare_records(old, new, "owner", F.concat_ws("|", "title", F.coalesce("year", F.lit(0)).cast("string")))
    assert rows(out) == [(1, 3, 2, 1, 1, 1, 0), (2, 1, 1, 1, 0, 0, 0), (3, 0, 1, 0, 0, 0, 1)]
    assert "FlatMapGroupsInPandas" not in out._jdf.queryExecution().executedPlan().toString()


def test_versions_at_one_place_give_one_document_in_any_order_of_rows(spark):
    kind = "k long, o int, tags array<string>, note string, first long, people array<struct<id: string, full_name: string, role: string>>"
    versions = [(1, 0, ["N"], "n", None, []), (1, 1, ["R"], "r", 9, [("c", "Rosa", "author")]), (1, 1, ["A"], "a", 5, [("c", "Ana", "author")]), (1, 1, ["A"], "b", 7, []), (1, 2, ["R"], "r", 1, [])]
    for order in (versions, versions[::-1], versions[2:] + versions[:2]):
        out = merge.merged_documents(spark.createDataFrame(order, kind).coalesce(1), "k", ["o"], ["tags"], ["note"], ["first"], "people")
        assert rows(out.select("versions", F.array_join("tags", "|"), "note", "first", F.array_join("people.full_name", "|"))) == [(5, "N|A|R", "r", 5, "Ana|Rosa")]


def test_an_author_without_a_name_leaves_advisors_in(spark):
    people = [("a", None, "author"), ("b", "Ana", "advisor"), ("c", "Rosa", "author")]
    df = spark.createDataFrame([(people,), ([*people, ("b", "Ana", "author")],)], "people array<struct<id: string, full_name: string, role: string>>")
    got = [[(p["id"], p["full_name"], p["role"]) for p in r[0]] for r in df.select(occurrences.merged_authors(F.col("people"))).collect()]
    assert got == [[people[0], people[2], people[1]], [people[0], people[2], ("b", "Ana", "author")]]


def test_regular_pages_are_cut_at_tags_into_the_tree_that_the_parser_makes(spark):
    from cordillera.sources import markup

    def shown(node):
        return node.tag, node.attrs, [shown(x) if isinstance(x, markup.Node) else x for x in node.children]

    regular = ["", "x &amp; &eacute", "<table><tr><td>a<td>b<tr><td>c</table>d", '<TD Class="x"><br/><br>&nbsp;</td></p>', "<p>a<p>b<li>c > d</ul>", '<a href="x" href="y">z']
    odd = ["a < b", "<script>x<b></script>", "<!-- <b> -->", '<a href="x&amp;y">', "<a href=x>", "<title><b></title>", "<td", "</td x>", "<a b>"]
    for page in regular + odd:
        parser = markup._Builder()
        parser.feed(page)
        parser.close()
        assert shown(markup.tree(page)) == shown(parser.root)
    assert all(markup._regular(page) for page in regular) and not any(markup._regular(page) for page in odd)
    deep = "<b>" * 5000 + "x"
    assert markup.tree(deep).text() == "x" and len(markup.tree(deep).all("b")) == 5000


def test_products_of_group_pages_are_rows_with_the_fields_asked_for(spark):
    row = "<tr><td></td><td>{}.- <strong>{}</strong> : {}<br>{}</td></tr>"
    head = '<table><tr><td class="celdaEncabezado">{}</td></tr>'
    said = ["Colombia, 2001, ISBN: 9780306406157, Autores: Ana Paz, Luis Gil", "Desde 2001 hasta 2002, Tipo de orientación: x Tutor(es)/Cotutor(es): Eva Sol", "", "páginas: 3-5, Nombre del titular: Acme, doi: 10.1234/A"]
    page = "".join(head.format(h) + "".join(row.format(k, "Libro", f"T{k} {mark}", rest) for k, (mark, rest) in enumerate((m, r) for m in ("", "número de", "Nombre del titular: B") for r in said)) + "</table>" for h in ("Libros", "Signos distintivos", "Trabajos dirigidos/turorías", "Instituciones"))
    df = spark.createDataFrame([("c1", page), ("c2", None), (None, page)], "id string, html string")
    fields = ["source_section", "title", "authors", "doi", "isbn", "pages", "holder", "advisors", "start_date", "year", "validated"]
    got = records.group_products(df, "id", "html", {"Libro": "Libro"}, fields)
    assert got.columns == ["code", *fields]
    whole = records.group_pages(df.where("id is not null"), "id", "html", {"Libro": "Libro"}).select("code", F.explode("production").alias("p")).select("code", *[f"p.{f}" for f in fields])
    known = sorted(map(repr, got.where("code is not null").collect()))
    assert len(known) == 36 and known == sorted(map(repr, whole.collect()))
    assert got.where("code is null").count() == 36
