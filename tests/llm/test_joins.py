"""The two similarity joins, components and archives."""

import gzip
import random

import numpy as np
import pytest

from cordillera.llm.components import components
from cordillera.llm.embedding_dedup import embedding_links
from cordillera.llm.jaccard_join import jaccard_components, keep_one_of_each
from cordillera.llm.warc import SEGMENT_BYTES, from_chunks, http_payload, parse, payload_digest, read_warc, record_name, records, to_chunks, warc_round_trip, write_warc


def roots(nodes, edges):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in nodes}


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}


def near_texts():
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(25)]
    texts = [None, "", " ", "one", "One", "one two", "a b c d e", "A b c\td e", "a b c d e f"]
    for k in range(40):
        base = [word() for _ in range(rng.choice([6, 12, 40, 150]))]
        if k % 4 == 0:
            base += passage
        texts.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 4])):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    base = [word() for _ in range(120)]
    for _ in range(60):  # a large region: a chain of edits that leaves the pivot's neighbourhood
        base[rng.randrange(len(base))] = word()
        texts.append(" ".join(base))
    order = list(range(len(texts)))
    rng.shuffle(order)
    return list(zip(order, texts))


@pytest.mark.parametrize("block, broadcast_ids", [(256, 1000), (8, 0)])
def test_jaccard(spark, block, broadcast_ids):
    texts = near_texts()
    sets = {i: shingles(t) for i, t in texts}
    edges = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = {i: (len(sets[i]), r) for i, r in roots(sets, edges).items()}
    df = spark.createDataFrame([(i, t, "c", 3, 4) for i, t in texts], "doc_id long, text string, id string, size int, rep int").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in jaccard_components(df, block=block, broadcast_ids=broadcast_ids).collect()}
    assert got == want
    kept = keep_one_of_each(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {i for i, w in want.items() if w[1] == i}


def brute_components(texts):
    sets = {i: shingles(t) for i, t in texts}
    by = {}
    for i, own in sets.items():
        for x in own:
            by.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in by.values() for a in ids for b in ids if a < b}
    return sets, roots(sets, [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])])


def test_jaccard_of_shared_shingles_stays_linear(spark, monkeypatch):
    """One shingle that all short documents share brings them together once, not in the second order."""
    from cordillera.llm import jaccard_join as module

    rng = random.Random(2)
    own = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = [(k, " ".join(["one", "two", "three", "four", "five", *own(rng.choice([2, 4, 9]))])) for k in range(400)]
    texts += [(1000 + k, t + " end") for k, (_, t) in enumerate(texts[:40])]
    divided = []
    before = module._divided
    monkeypatch.setattr(module, "_divided", lambda *x: divided.append(1) or before(*x))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    _, want = brute_components(texts)
    got = {r[0]: r["component_id"] for r in jaccard_components(df, block=16).collect()}
    assert got == want and not divided


@pytest.mark.parametrize("block", [8, 24])
def test_jaccard_divides_large_groups(spark, block):
    """Templates that share nearly all shingles: prefixes cannot part them, cells and blocks must."""
    rng = random.Random(6)
    texts = []
    for group in range(3):
        base = [f"g{group}w{k}" for k in range(40)]
        for k in range(90):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5)}"
            texts.append((1000 * group + k, " ".join(copy)))
    _, want = brute_components(texts)
    got = {r[0]: r["component_id"] for r in jaccard_components(spark.createDataFrame(texts, "doc_id long, text string").repartition(3), block=block).collect()}
    assert got == want and len(set(want.values())) > 3


def test_jaccard_rows_that_repeat_an_id(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(5, a), (5, b), (5, b + " end"), (None, b), (None, c), (None, c + " end"), (None, c + " end"), (3, a + " end"), (9, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((str(r[0]), r[1], str(r[2])) for r in jaccard_components(df).collect())
    assert got == sorted([("5", 26, "3"), ("5", 26, "5"), ("5", 27, "5"), ("None", 26, "5"), ("None", 26, "None"), ("None", 27, "None"), ("None", 27, "None"), ("3", 27, "3"), ("9", 0, "9"), ("9", 0, "9")])
    kept = sorted((str(r[0]), r[1] or "") for r in keep_one_of_each(df).collect())
    assert len(kept) == 5 and [i for i, _ in kept] == ["3", "5", "9", "9", "None"] and kept[1][1].startswith("b0")
    assert jaccard_components(df.limit(0)).collect() == [] and keep_one_of_each(df.limit(0)).collect() == []


def test_jaccard_threshold_is_exact(spark):
    base = [f"w{k}" for k in range(18)]  # 14 shingles
    texts = [(1, " ".join(base[:15])), (2, " ".join(base[:12])), (3, " ".join(base[:11]))]  # 11, 8 and 7: 8/11 < 0.75 < 7/8
    got = {r[0]: r["component_id"] for r in jaccard_components(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 2}
    texts = [(1, " ".join(base[:16])), (2, " ".join(base[:13]))]  # 12 and 9: exactly 0.75
    got = {r[0]: r["component_id"] for r in jaccard_components(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1}


def near_vectors():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 12))
    rows = [c + rng.standard_normal(12) * rng.choice([0.02, 0.08, 0.3]) for c in centres for _ in range(8)]
    rows += [rows[0]] * 20 + [rows[5] * 3, rows[5] * 1e-30]
    out = [[float(np.float32(x)) for x in r] for r in rows]
    out += [None, [], [0.0] * 12, [float("nan")] + [1.0] * 11, [float("inf")] + [1.0] * 11, [None] + [1.0] * 11, [1.0] * 11]
    return list(enumerate(out))


@pytest.mark.parametrize("interval", [None, 4096, 16])
def test_embeddings(spark, interval):
    rows = near_vectors()
    ok = {i: np.array(v, float) for i, v in rows if v and len(v) == 12 and None not in v and np.isfinite(v).all() and any(v)}
    ids = list(ok)
    x = np.stack([ok[i] / np.abs(ok[i]).max() for i in ids])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    edges = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))]
    links = dict(zip(ids, near.sum(1).tolist()))
    want = {i: (links.get(i, 0), r, r == i) for i, r in roots([i for i, _ in rows], edges).items()}
    df = spark.createDataFrame([(i, v, 1, "n") for i, v in rows], "vec_id long, embedding array<float>, label int, n string").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in embedding_links(df, interval=interval).collect()}
    assert got == want
    assert embedding_links(df.limit(0)).collect() == []
    assert {tuple(r[1:]) for r in embedding_links(df.where("embedding is null")).collect()} == {(0, df.where("embedding is null").first()[0], True)}


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(0, 200)] + [(1000 + rng.randrange(300), 1000 + rng.randrange(300)) for _ in range(250)] + [(7, 7)]
    want = {x: r for x, r in roots({x for e in edges for x in e}, [e for e in edges if e[0] != e[1]]).items() if x != r}
    df = spark.createDataFrame(edges, "a long, b long").repartition(8)
    assert {r[0]: r[1] for r in components(df).collect()} == want
    assert components(df.limit(0)).collect() == []


def test_chunks():
    for body in (b"", b"x", bytes(range(256)) * 100):
        assert from_chunks(to_chunks(body, 100)) == body
    assert from_chunks(b"3;a=b\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        from_chunks(b"2\r\nabc\r\n0\r\n\r\n")


def test_parse_goes_by_length():
    page = b"WARC/1.1\r\n\r\n\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\n"
    archive = b"".join(r + b"\r\n\r\n" for r in records(record_name(5), "http://x/", page, None, 40))
    for data in (archive, gzip.compress(archive[:500]) + gzip.compress(archive[500:])):
        found = list(parse(data))
        assert len(found) > 3 and http_payload(b"".join(b for _, b in found)) == page
    with pytest.raises(ValueError):
        list(parse(archive[:-8]))


def test_warc(spark, tmp_path):
    long = "é<p>\r\n\r\nWARC/1.1\r\n" * 20_000
    pages = [(3, "http://a/", "same"), (1, None, "same"), (2, "http://b/", None), (4, "c", ""), (5, "d", long), (6, "e", long), (7, "f", "x")]
    df = spark.createDataFrame([(*p, "clash", 1) for p in pages], "page_id long, url string, html string, digest string, id int").repartition(3)
    want, first = {}, {}
    for i, _, html in sorted(pages):
        body = (html or "").encode()
        to = first.setdefault(body, i)
        want[i] = (len(body), payload_digest(body), "response" if to == i else "revisit", None if to == i else to)
    assert {r[0]: tuple(r[1:]) for r in warc_round_trip(df).collect()} == want
    path = f"file://{tmp_path}/w"
    write_warc(df, path, min_revisit_bytes=5, compression="none")
    read = {r["id"]: r for r in read_warc(spark, path).collect()}
    assert {i: (r["kind"], r["payload"] and bytes(r["payload"])) for i, r in read.items()} == {
        i: ("revisit", None) if i == 6 else ("response", (html or "").encode()) for i, _, html in pages
    }
    assert len(long.encode()) > 3 * SEGMENT_BYTES
    assert warc_round_trip(df.limit(0)).collect() == []


def test_lost_segments_are_noticed(spark, tmp_path):
    own = list(records(record_name(1), "u", b"y" * 100_000, None))
    (tmp_path / "a.warc").write_bytes(b"".join(r + b"\r\n\r\n" for r in own[:1] + own[2:]))
    with pytest.raises(Exception, match="missing"):
        read_warc(spark, f"file://{tmp_path}").collect()


def test_embeddings_of_every_length_link(spark):
    rng = np.random.default_rng(8)
    rows, base = [], {d: rng.normal(size=d) for d in (3, 8)}
    for d, ids in ((8, (-5, -4, 10)), (3, (-9, -1, 7, 8)), (5, (20,))):
        for i in ids:
            rows.append((i, (base.get(d, np.ones(d)) * (2.0 + i % 3)).tolist()))
    rows.append((30, rng.normal(size=8).tolist()))
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {-5: (2, -5), -4: (2, -5), 10: (2, -5), -9: (3, -9), -1: (3, -9), 7: (3, -9), 8: (3, -9), 20: (0, 20), 30: (0, 30)}


def test_warc_rows_that_share_an_id(spark, tmp_path):
    evil = "http://a/\r\nContent-Length: 3\r\n\r\nx y\x00\x7f"
    long = "z" * 100_000
    pages = [(3, evil, "x"), (3, evil, "x"), (3, "http://b/", "x"), (3, "http://b/", "y"), (2, "u", "y"), (None, "v", "x"), (None, "v", None), (None, "v", None), (None, "v", long), (8, "w", long), (8, "w", long), (9, evil, "only")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc_round_trip(df).collect()), key=str)
    want = [(3, 1, "response", None), (3, 1, "revisit", 3), (3, 1, "revisit", 3), (None, 1, "revisit", 3), (2, 1, "response", None), (3, 1, "revisit", 2)]
    want += [(None, 0, "response", None), (None, 0, "revisit", None), (8, len(long), "response", None), (8, len(long), "revisit", 8), (None, len(long), "revisit", 8), (9, 4, "response", None)]
    assert got == sorted(want, key=str)
    path = f"file://{tmp_path}/w"
    write_warc(df, path, min_revisit_bytes=10**9)
    read = read_warc(spark, path).collect()
    assert len({r["name"] for r in read}) == len(pages) and sorted(bytes(r["payload"]) for r in read) == sorted((h or "").encode() for _, _, h in pages)
    assert {r["uri"] for r in read if r["id"] == 9} == {"http://a/%0D%0AContent-Length:%203%0D%0A%0D%0Ax%20y%00%7F"}


def test_embeddings_of_rows_that_repeat_an_id(spark):
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (5, [0.0, 1.0]), (None, [1.0, 0.01]), (None, [3.0, 3.0]), (None, [3.0, 3.1]), (4, [2.0, 0.0]), (None, None), (8, [1.0]), (8, None)]
    got = sorted(map(str, map(tuple, embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect())))
    want = [(5, 2, 4, False), (5, 1, 5, True), (5, 1, 5, True), (None, 2, 4, False), (None, 1, None, True), (None, 1, None, True), (4, 2, 4, True), (None, 0, None, True), (8, 0, 8, True), (8, 0, 8, True)]
    assert got == sorted(map(str, want))


def test_embeddings_over_several_intervals_and_cells(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((6, 3))
    x = np.concatenate([c + rng.standard_normal((60, 3)) * 0.05 for c in centres]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    want = roots(range(len(x)), list(zip(*(k.tolist() for k in np.nonzero(near)))))
    got = {r[0]: (r[1], r[2]) for r in embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3), interval=9).collect()}
    assert got == {i: (int(near[i].sum()), want[i]) for i in range(len(x))}


def test_embeddings_keep_large_ids(spark):
    big = 9_007_199_254_740_993
    rows = [(big, [1.0, 0.0]), (big + 1, [1.0, 0.1]), (big + 2, [0.0, 1.0]), (-big, [1.0, 0.05])]
    got = {r[0]: (r[1], r[2]) for r in embedding_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {big: (2, -big), big + 1: (2, -big), big + 2: (0, big + 2), -big: (2, -big)}
