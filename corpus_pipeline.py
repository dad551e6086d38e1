"""The corpus pipeline: reject bad documents, drop near copies, mask secrets, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next one's documents. All but the last return the
columns of ``documents``. A stage works on all that the one before it kept.
"""

from tillroll.llm import packing, secrets_crf, simhash, weak_quality
from tillroll.llm.common import importable
from tillroll.session import fresh_folder


def quality_rules(spark, docs, sf_dir):
    """Documents that the label model or the base rule rejects go."""
    return weak_quality.keep_good(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of linked fingerprints stays: four-word shingles,
    at most four differing bits."""
    return simhash.drop_near_duplicates(docs, shingle=4, radius=4)


def secret_scan(spark, docs, sf_dir):
    """Every span found is replaced by its kind; ``n_chars`` follows the text."""
    return secrets_crf.redact(docs, length="n_chars")


def pack(spark, docs, sf_dir):
    """The documents' ids in sequences of 4096, one row per piece, with the ids."""
    return packing.pack(docs, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

# Learned models and a tokenizer have no SQL: tests hold run() against a
# brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    importable(spark)
    for name, stage in STAGES:
        folder = fresh_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
