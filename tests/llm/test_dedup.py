"""Exact, line and substring dedup against brute force."""

import hashlib
import random

import pytest

from cordillera.llm.exact_dedup import exact_dedup, exact_groups
from cordillera.llm.line_dedup import line_dedup, line_report
from cordillera.llm.substring_dedup import repeated_spans, repeated_windows, substring_dedup, substring_report

SCHEMA = "doc_id long, text string, id string, size int, kept string, n_chars long"


def frame(spark, texts, partitions=3):
    rows = [(i, t, "x", 1, "y", len(t or "")) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def odd_texts():
    rng = random.Random(5)
    words = ["a", "B", "cé", "dd", "e.", "日本"]
    texts = [None, "", "", None, " ", "\n\n\n\n", "Ab", "aB", "ÄB", "äb", "x" * 50_000]
    passage = " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(30))
    for k in range(60):
        own = [rng.choice(words) + str(rng.randrange(30)) for _ in range(rng.randrange(1, 40))]
        if k % 3 == 0:
            own.insert(rng.randrange(len(own)), passage)
        text = rng.choice([" ", "\t", "\n", "  "]).join(own)
        texts += [text] * rng.choice([1, 1, 1, 3])
    order = list(range(len(texts)))
    rng.shuffle(order)
    return list(zip(order, texts))


def lower(text):
    return (text or "").encode().lower().decode()


@pytest.mark.parametrize("keep", ["max", "min"])
def test_exact(spark, keep):
    texts = odd_texts()
    groups = {}
    for i, t in texts:
        groups.setdefault(lower(t), []).append(i)
    want = {}
    for t, ids in groups.items():
        k = (max if keep == "max" else min)(ids)
        for i in ids:
            want[i] = (k, len(ids), i == k, hashlib.sha256(t.encode()).hexdigest())
    got = {r[0]: tuple(r[1:]) for r in exact_groups(frame(spark, texts), keep=keep).collect()}
    assert got == want
    kept = exact_dedup(frame(spark, texts), keep=keep)
    assert kept.columns == frame(spark, texts).columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, w in want.items() if w[2]}


def test_one_text_in_all_rows_spans_partitions(spark):
    df = frame(spark, [(i, "Same" if i % 2 else "same") for i in range(4000)], 8)
    rows = exact_groups(df).collect()
    assert {(r["keep_id"], r["group_size"]) for r in rows} == {(3999, 4000)} and len(rows) == 4000


def lines_brute(texts, width=3):
    seen, gone = set(), {}
    for i, t in sorted(texts, key=lambda x: x[0]):
        lines = [] if t is None else t.split("\n")
        for k in range(len(lines) - width + 1):
            window = tuple(lines[k : k + width])
            if window in seen:
                gone.setdefault(i, set()).update(range(k, k + width))
            seen.add(window)
    out = {}
    for i, t in texts:
        lines = [] if t is None else t.split("\n")
        kept = [x for k, x in enumerate(lines) if k not in gone.get(i, ())]
        out[i] = (len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def test_lines(spark):
    rng = random.Random(3)
    texts = odd_texts()
    shared = "\n".join(f"line {k}" for k in range(6))
    texts += [(1000 + k, "\n".join([f"own {k}", shared, f"end {rng.random()}"])) for k in range(5)]
    texts += [(2000, "a\na\na\na\na\na"), (2001, "\n".join(["p", "q", "r"] * 3)), (2002, shared)]
    got = {r[0]: tuple(r[1:]) for r in line_report(frame(spark, texts)).collect()}
    assert got == lines_brute(texts)
    df = frame(spark, texts)
    kept = {r["doc_id"]: r["text"] for r in line_dedup(df).collect()}
    assert 2002 not in kept and kept[1001].startswith("own 1\nend") and line_dedup(df).columns == df.columns
    assert {i: kept[i] for i, t in texts if t is None} == {i: None for i, t in texts if t is None}


def substring_brute(texts, window):
    words = {i: (t or "").encode().split() for i, t in texts}
    low = {}
    for i, w in words.items():
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            low[key] = min(low.get(key, i), i)
    out = {}
    for i, w in words.items():
        gone = {j for k in range(len(w) - window + 1) if low[tuple(w[k : k + window])] < i for j in range(k, k + window)}
        kept = [x for k, x in enumerate(w) if k not in gone]
        out[i] = (len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


@pytest.mark.parametrize("hot", [0, 3, 256])
def test_substrings(spark, hot):
    texts = odd_texts()
    texts += [(500 + k, " ".join(["again"] * (6 + k))) for k in range(4)]
    got = {r[0]: tuple(r[1:]) for r in substring_report(frame(spark, texts), window=7, seed=3, hot=hot).collect()}
    want = substring_brute(texts, 7)
    assert got == want and any(w[1] for w in want.values())


def test_substring_texts(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    texts = [(1, f"one\t {passage} end"), (2, f"two\n{passage}  fin"), (3, passage), (4, None), (5, ""), (6, "short  text")]
    df = frame(spark, texts)
    out = substring_dedup(df)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert out.columns == df.columns
    assert got == {1: (texts[0][1], len(texts[0][1])), 2: ("two fin", 7), 4: (None, None), 5: ("", 0), 6: ("short  text", 11)}


def test_windows_with_equal_hashes_are_told_apart(monkeypatch):
    import numpy as np

    from cordillera.llm import substring_dedup as module

    monkeypatch.setattr(module, "spans_hash", lambda values, a, b: np.zeros(len(a), np.uint64))
    words = [b"a", b"b", b"c", b"a", b"b", b"c", b"d"]
    string, place = repeated_windows(words, np.array([0, 3, 7]), np.array([1, 2]), 3)
    assert list(zip(string.tolist(), place.tolist())) == [(1, 0)]


def test_empty_tables(spark):
    df = frame(spark, [])
    for f in (exact_groups, line_report, line_dedup, substring_report, substring_dedup, exact_dedup, repeated_spans):
        assert f(df).collect() == []


REPEATED = [(5, "a"), (5, "a"), (4, "a"), (5, "A"), (5, "b"), (None, "b"), (None, "c"), (None, "C"), (None, "c"), (6, None), (6, ""), (7, "d")]


@pytest.mark.parametrize("keep", ["max", "min"])
@pytest.mark.parametrize("partitions", [1, 4])
def test_exact_keeps_one_row_whatever_the_ids(spark, keep, partitions):
    groups = exact_groups(frame(spark, REPEATED * 30, partitions), keep=keep).collect()
    assert len(groups) == 30 * len(REPEATED)
    size = {hashlib.sha256(t.encode()).hexdigest(): 30 * n for t, n in (("a", 4), ("b", 2), ("c", 3), ("", 2), ("d", 1))}
    best = {"a": 5 if keep == "max" else 4, "b": 5, "c": None, "": 6, "d": 7}
    best = {hashlib.sha256(t.encode()).hexdigest(): k for t, k in best.items()}
    assert {r["text_sha256"]: (r["group_size"], r["keep_id"]) for r in groups} == {h: (n, best[h]) for h, n in size.items()}
    assert sorted(r["text_sha256"] for r in groups if r["kept"]) == sorted(size) and all(r["doc_id"] == r["keep_id"] for r in groups if r["kept"])
    kept = exact_dedup(frame(spark, REPEATED * 30, partitions), keep=keep).collect()
    assert sorted((r["text"] or "").lower() for r in kept) == ["", "a", "b", "c", "d"]
    assert {(r["text"] or "").lower(): r["doc_id"] for r in kept} == {t: best[hashlib.sha256(t.encode()).hexdigest()] for t in "abcd"} | {"": 6}


def test_rows_that_repeat_an_id_lose_only_their_own_words(spark):
    one = [f"p{k}" for k in range(60)]
    texts = [(1, " ".join(one)), (2, " ".join(one + [f"x{k}" for k in range(20)])), (2, " ".join([f"y{k}" for k in range(60)] + one[:55])), (2, " ".join(one + [f"x{k}" for k in range(20)])), (3, "z")]
    for hot in (0, 256):
        got = sorted(tuple(r)[:3] for r in substring_report(frame(spark, texts), hot=hot).collect())
        assert got == [(1, 60, 0), (2, 80, 60), (2, 80, 60), (2, 115, 55), (3, 1, 0)]
    kept = sorted(r["text"] for r in substring_dedup(frame(spark, texts)).collect() if r["doc_id"] == 2)
    assert kept[0] == kept[1] == " ".join(f"x{k}" for k in range(20)) and kept[2] == " ".join(f"y{k}" for k in range(60))


def test_lines_of_rows_that_repeat_an_id(spark):
    texts = [(1, "a\nb\nc"), (2, "a\nb\nc\nd"), (2, "x\ny\nz\na\nb\nc"), (2, "x\ny\nz\na\nb\nc"), (3, "q\nx\ny\nz"), (4, "u\nv\nw"), (4, "u\nv\nw")]
    got = sorted(tuple(r)[:3] for r in line_report(frame(spark, texts)).collect())
    assert got == [(1, 3, 0), (2, 4, 3), (2, 6, 3), (2, 6, 3), (3, 4, 3), (4, 3, 0), (4, 3, 0)]


@pytest.mark.parametrize("repeated", [False, True])
def test_texts_are_shuffled_once_by_substring_report(spark, tmp_path, repeated):
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [(i, f"a{i} {passage} b{i}" if i % 3 == 0 else f"c{i}") for i in range(30)] + [(3, "again")] * repeated + [(None, passage)]
    frame(spark, texts).write.parquet(str(tmp_path / "docs"))
    sizes = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in sizes}
    try:
        for k, v in sizes.items():
            spark.conf.set(k, v)
        out = substring_report(spark.read.parquet(str(tmp_path / "docs")))
        got = sorted((r[0] if r[0] is not None else -1, r["n_words"], r["n_removed"]) for r in out.collect())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == sorted([(i, 62, 60 if i else 0) if i % 3 == 0 else (i, 1, 0) for i in range(30)] + [(3, 1, 0)] * repeated + [(-1, 60, 0)])
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_texts_are_cut_once_by_substring_dedup(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    out = substring_dedup(frame(spark, [(1, f"a {passage}"), (2, f"b  {passage} c"), (3, passage), (4, "x  y"), (5, None)]))
    assert sorted((r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()) == [(1, f"a {passage}", len(passage) + 2), (2, "b c", 3), (4, "x  y", 4), (5, None, None)]
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ArrowEvalPython") == 1
