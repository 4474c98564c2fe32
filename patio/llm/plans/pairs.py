"""Near-duplicate vectors and texts, and whitened vectors."""

from patio.llm.common import table
from patio.llm.texts import near_texts
from patio.llm.vectors import near_vectors
from patio.llm.whitening import whiten


def op9_ngram_jaccard(spark, sf_dir):
    return near_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])


def op10_embedding_near_dedup(spark, sf_dir):
    return near_vectors(table(spark, sf_dir, "embeddings"), keep=["vec_id"])


def op12_embedding_whitening(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"), keep=["vec_id"])


QUERIES = {"op9_ngram_jaccard": op9_ngram_jaccard,
           "op10_embedding_near_dedup": op10_embedding_near_dedup,
           "op12_embedding_whitening": op12_embedding_whitening}
ORACLES = {}
