"""A corpus pipeline: each stage works on what its predecessor kept.

The stages are operators of ``cordillera.llm`` with their defaults, and what they say
of odd rows holds here: texts that are null or empty have the score of no neighbours,
are one group of equal texts, link with no near copy, lose no words, and are one
sequence piece of one token.  Very long texts go through whole.  Rows that repeat an id
or have none are documents like others, of which each stage keeps or drops one row at a
time.  Ties go by id.  Columns beside the id and the text stay as they are up to the
last stage, whatever their names.  An empty table gives an empty result.

Each stage's table is written to the shared folder and read again; a table is deleted
when its successor has been written, the last one stays, as the result reads it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cordillera.llm.common import lean, remove, shared_path, table
from cordillera.llm.exact_dedup import exact_dedup
from cordillera.llm.jaccard_join import keep_one_of_each
from cordillera.llm.packing import pack_documents
from cordillera.llm.quality import keep_quality
from cordillera.llm.substring_dedup import substring_dedup


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    lean(spark)
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the largest doc_id stays."""
    lean(spark)
    return exact_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the smallest doc_id stays."""
    lean(spark)
    return keep_one_of_each(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out; documents without any stay as they are."""
    lean(spark)
    return substring_dedup(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, placed in training sequences."""
    lean(spark)
    return pack_documents(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near_duplicates),
    ("substring dedup", substrings),
    ("best-fit packing", packing),
]

#: The classifier, the shingle join's components and the packing are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    where = shared_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{where}/{k}")
        if k:
            remove(spark, f"{where}/{k - 1}")
        docs = spark.read.schema(out.schema).parquet(f"{where}/{k}")
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
