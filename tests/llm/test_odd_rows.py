"""Rows without an id, and columns with clashing names, in every operator."""

from pyspark.sql import functions as F

from cordillera.llm.bpe import bpe_encode, bpe_round_trip
from cordillera.llm.embedding_dedup import embedding_links
from cordillera.llm.exact_dedup import exact_dedup, exact_groups
from cordillera.llm.jaccard_join import jaccard_components, keep_one_of_each
from cordillera.llm.line_dedup import line_dedup, line_report
from cordillera.llm.packing import pack_documents
from cordillera.llm.quality import keep_quality, score_quality
from cordillera.llm.substring_dedup import substring_dedup, substring_report
from cordillera.llm.toxicity import score_toxicity
from cordillera.llm.warc import warc_round_trip

CLASH = ["id", "rep", "size", "n", "part", "run", "mini", "first", "slice", "digest", "kept", "score", "keep_id", "place", "lines", "a", "b", "pivot", "rank", "task", "length"]


def docs(spark):
    rows = [(None, "same text here to see"), (1, "same text here to see"), (2, "same text here to see"), (None, None), (3, "a\nb\nc\nd"), (4, "a\nb\nc\ne")]
    df = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long")
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASH]).repartition(2)


def test_reports_have_rows_without_an_id(spark):
    df = docs(spark)
    for report in (exact_groups, jaccard_components):
        assert sorted(r["doc_id"] or 0 for r in report(df).collect()) == [0, 0, 1, 2, 3, 4], report
    encode, trip = (lambda df, f=f: f(df, "byte_bpe_50k.json") for f in (bpe_encode, bpe_round_trip))
    for report in (line_report, substring_report, encode, trip):
        assert sorted(r["doc_id"] or 0 for r in report(df).collect()) == [0, 0, 1, 2, 3, 4], report
    assert sorted(r["doc_id"] or 0 for r in pack_documents(df).collect()) == [0, 0, 1, 2, 3, 4]
    assert {r["doc_id"]: r["n_removed"] for r in line_report(df).collect()}[4] == 3


def test_filters_keep_rows_without_an_id(spark):
    df = docs(spark)
    for keep, ids in ((exact_dedup, [0, 2, 3, 4]), (keep_one_of_each, [0, 1, 3, 4]), (line_dedup, [0, 0, 1, 2, 3, 4]), (substring_dedup, [0, 0, 1, 2, 3, 4])):
        out = keep(df)
        assert out.columns == df.columns and sorted(r["doc_id"] or 0 for r in out.collect()) == ids, keep


def test_scores_of_rows_without_an_id(spark):
    df = docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for score in (score_quality, score_toxicity):
        assert len(score(df, labels).collect()) == 6
    assert keep_quality(df, labels).columns == df.columns


def test_other_tables(spark):
    pages = spark.createDataFrame([(None, "u", "x"), (1, "u", "x"), (2, "v", "x")], "page_id long, url string, html string").withColumn("id", F.lit(5)).withColumn("payload", F.lit(b"x"))
    assert sorted((r["page_id"] or 0, r["record_type"]) for r in warc_round_trip(pages).collect()) == [(0, "revisit"), (1, "response"), (2, "revisit")]
    vectors = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.1])], "vec_id long, embedding array<double>").withColumn("v", F.lit(1)).withColumn("n", F.lit(1))
    assert sorted((r[0] or 0, *r[1:]) for r in embedding_links(vectors).collect()) == [(0, 2, 1, False), (1, 2, 1, True), (2, 2, 1, False)]
