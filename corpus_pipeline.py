"""The training-data pipeline: quality, toxicity, near-duplicates, personal data, packing.

``STAGES`` are applied in order to ``documents``; each stage's result is
written as Parquet and read again as the next one's documents. All but the
last keep the columns of ``documents``; the last returns the packed pieces.

Rows with NULL or empty texts, repeated rows and NULL ids go through every
stage: they are scored like any text, an empty table stays empty, and
further columns are carried along.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import common, icws, packing, pii, quality, toxicity
from quern.llm.queries import BYTE_VOCABULARY
from quern.session import ensure_checkpoint_dir

QUALITY_THRESHOLD = 0.5
TOXICITY_THRESHOLD = 0.3


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents with a quality score below 0.5 go. The model learns from the labelled ``documents``."""
    table = common.table(spark, sf_dir, "documents", "doc_id", "text")
    model = quality.train_on(table, common.table(spark, sf_dir, "labels", "doc_id", "quality"))
    score = _free(docs, "_quality")
    return quality.with_score(docs, model, score).filter(F.col(score) >= QUALITY_THRESHOLD).drop(score)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents with a toxicity score of 0.3 or more go. The model learns from the labelled ``documents``."""
    table = common.table(spark, sf_dir, "documents", "doc_id", "text")
    model = toxicity.train_on(table, common.table(spark, sf_dir, "labels", "doc_id", "toxic"))
    score = _free(docs, "_toxicity")
    return toxicity.with_score(docs, model, score).filter(F.col(score) < TOXICITY_THRESHOLD).drop(score)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each class of near-duplicates the document of least id stays; NULL texts all stay."""
    return icws.one_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: personal data is replaced by its kind; ``n_chars`` follows the text."""
    return pii.redact(docs, length_col="n_chars" if "n_chars" in docs.columns else None)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the documents packed into sequences of 2048 tokens."""
    with open(BYTE_VOCABULARY, encoding="utf-8") as f:
        return packing.pack(docs, f.read(), added_tokens=True)


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

# The stages are models, sketches and tokenizers; no SQL expresses them. Each
# is tested against its own brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared checkpoint folder and read again."""
    docs = common.table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark)}/corpus_pipeline-{uuid.uuid4()}"
    for i, (name, stage) in enumerate(STAGES):
        place = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(place)
        docs = spark.read.parquet(place)
    return docs
