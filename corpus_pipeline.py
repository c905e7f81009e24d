"""From raw documents to packed training sequences, as five stages.

Each stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and
returns what the next one gets as ``docs``, written as Parquet in between. All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stagewise.llm import best_fit, decontaminate, line_dedup, order_minhash, quality
from stagewise.llm.common import materialize, read_table
from stagewise.llm.queries import tokenizer_file


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the quality classifier rejects (a NULL text is scored as empty)."""
    return quality.keep_quality(docs, quality.fit_quality(docs, read_table(spark, sf_dir, "labels")))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts boilerplate lines out of the texts; ``n_chars`` follows the text."""
    return line_dedup.recount(line_dedup.drop_boilerplate(docs))


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate class."""
    return order_minhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences."""
    return best_fit.pack_documents(docs, tokenizer_file())


STAGES = [
    ("quality_classifier", good_quality),
    ("line_dedup", without_boilerplate),
    ("near_dedup", without_near_copies),
    ("decontaminate", without_benchmark),
    ("best_fit_packing", packed),
]

#: Trees, alignment and tokens can't be written in SQL; the tests compare each
#: stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written before the next reads them."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
