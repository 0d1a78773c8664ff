"""From raw documents to token ids: five stages that each work on what the one before kept.

Each stage takes ``(spark, docs, sf_dir)``, works on all of ``docs`` and returns the columns of
documents, but for the last, which returns ids. ``run`` writes each stage's rows as
Parquet below the session's checkpoint folder and reads them back for the next.
"""

from pyspark.sql import functions as F

from barkeep.llm.decontamination import remove_benchmark
from barkeep.llm.pieces import encoded_pieces
from barkeep.llm.quality import keep_quality
from barkeep.llm.repeats import remove_repeats
from barkeep.llm.simhash import drop_near_duplicates
from barkeep.scratch import stage

# Stretches of this many words that repeat are taken out.
REPEATED_WORDS = 50
# Near copies share four fifths of their shingles of this many words.
SHINGLE_WORDS = 5


def _counted(docs):
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind))


def quality_filter(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go. Null and empty texts are judged as empty ones."""
    return keep_quality(docs)


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near copies stays: the smallest id. Null and empty texts are copies of each other."""
    return drop_near_duplicates(docs, SHINGLE_WORDS)


def repeat_removal(spark, docs, sf_dir):
    """Repeated stretches are taken out of the texts; no row goes, null and empty texts stay as they are."""
    return _counted(remove_repeats(docs, REPEATED_WORDS, words=True))


def decontamination(spark, docs, sf_dir):
    """Passages of the benchmark are taken out of the texts; no row goes, null and empty texts stay as they are."""
    return _counted(remove_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def encoding(spark, docs, sf_dir):
    """Token ids of what is left, and the text they decode to; null and empty texts have no ids."""
    return encoded_pieces(docs)


STAGES = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("repeat_removal", repeat_removal),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# The stages are iterative or follow a library's tables; tests hold them against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
