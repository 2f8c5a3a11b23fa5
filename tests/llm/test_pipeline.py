"""The corpus pipeline against brute force, stage by stage."""

import corpus_pipeline
from test_dedup import lower
from test_joins import roots, shingles

from cordillera.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert [k for k, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "n-gram Jaccard join", "substring dedup", "best-fit packing"]
    docs = table(spark, SF, "documents")
    text = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    one = stages["quality classifier"](spark, docs, SF)
    assert one.columns == docs.columns
    accepted = text(one)
    assert 0 < len(accepted) < docs.count()

    two = stages["exact dedup"](spark, one, SF)
    assert two.columns == docs.columns
    last = {}
    for i in sorted(accepted):
        last[lower(accepted[i])] = i
    assert set(text(two)) == set(last.values())

    three = stages["n-gram Jaccard join"](spark, two, SF)
    sets = {i: shingles(t) for i, t in text(two).items()}
    edges = [(a, b) for a in sets for b in sets if a < b and sets[a] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])]
    component = roots(sets, edges)
    assert set(text(three)) == {i for i in sets if component[i] == i}

    four = stages["substring dedup"](spark, three, SF)
    assert four.columns == docs.columns and [f.dataType for f in four.schema] == [f.dataType for f in docs.schema]
    words = {i: t.encode().split() for i, t in text(three).items()}
    low = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 49):
            low.setdefault(tuple(words[i][k : k + 50]), i)
    want = {}
    for i, w in words.items():
        gone = {j for k in range(len(w) - 49) if low[tuple(w[k : k + 50])] < i for j in range(k, k + 50)}
        if len(gone) < len(w):
            want[i] = b" ".join(x for k, x in enumerate(w) if k not in gone).decode() if gone else text(three)[i]
    assert text(four) == want

    five = stages["best-fit packing"](spark, four, SF)
    assert {r["doc_id"] for r in five.collect()} == set(want)
    assert corpus_pipeline.run(spark, SF).count() == five.count()


def test_stages_on_odd_rows(spark, tmp_path):
    labels = [(k, k % 2, k % 2) for k in range(40)]
    words = [f"w{k}" for k in range(80)]
    texts = [(k, " ".join([*words[k : k + 20], "good" if k % 2 else "BAD!!"])) for k in range(40)]
    odd = [(100, None), (101, ""), (102, "x" * 300_000), (103, " ".join(words)), (103, " ".join(words)), (None, "w1 w2 w3 good"), (None, None), (104, " ".join(words + ["end"]))]
    rows = [(i, t, "en", "s", len(t or ""), "c", 1.5) for i, t in texts + odd]
    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, score double"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = table(spark, str(tmp_path), "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
        docs = out
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() > 0
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}/none").collect() == []
