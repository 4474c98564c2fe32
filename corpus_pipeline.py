"""Pipeline over the documents: quality rules, line dedup, near-copy removal, source mix, token ids.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept. The first four
return the columns of ``documents``; the last one returns each row's token ids. Between stages the
rows are written as Parquet in the shared folder and read again.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patio.llm.common import table
from patio.llm.lines import drop_boilerplate
from patio.llm.mixing import mix_documents
from patio.llm.plans.learned import MODEL
from patio.llm.quality import filter_quality
from patio.llm.sentences import PieceModel, encode_texts
from patio.llm.texts import drop_near_copies
from patio.session import durable


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all rules."""
    return filter_quality(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the boilerplate lines of their source. A document stays even if all its lines go."""
    return drop_boilerplate(docs, length="n_chars")


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    return drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies and parts of documents in the target proportions of their sources."""
    return mix_documents(docs, length="n_chars")


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each row's pieces."""
    coded = encode_texts(docs, PieceModel.read(MODEL), keep=["doc_id", "lang", "source"])
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("ngram_jaccard", ngram_jaccard),
          ("mix_sources", mix_sources), ("sentencepiece", sentencepiece)]

#: SQL can express neither the encoding nor the whole mix of texts; tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
