"""Corpus pipeline: five stages applied one after another to ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and works on all documents its
predecessor kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from firmlink.llm import decontaminate, lang_id, line_dedup, packing, simhash
from firmlink.llm.common import Tables

#: No threshold: only ``und`` is rejected. Scores fall with the number of
#: languages, so one least score has no fixed meaning.
MIN_LANGUAGE_SCORE = 0.0


def language_id(spark, docs, sf_dir):
    """Keep documents whose language is identified (op 6), by a model fitted on
    a sample of the stage's own labelled documents. Only texts without
    a letter (``und``) are rejected."""
    return lang_id.keep_identified(docs, lang_id.train(docs), min_score=MIN_LANGUAGE_SCORE)


def dedup_lines(spark, docs, sf_dir):
    """Drop lines that repeat an earlier line, exactly or nearly (op 1). A
    document stays, with fewer lines; ``n_chars`` is that of the new text."""
    out = line_dedup.drop_duplicate_lines(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def near_duplicates(spark, docs, sf_dir):
    """Keep one document of each SimHash group (op 7)."""
    return simhash.drop_near_duplicates(docs, shingle=3, max_bits=3)


def decontamination(spark, docs, sf_dir):
    """Drop documents that hold benchmark passages (op 9)."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=13)


def pack(spark, docs, sf_dir):
    """Pack the documents' token pieces into sequences (op 2)."""
    return packing.pack(docs, capacity=1024)


STAGES = [
    ("language ID", language_id),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", pack),
]

#: The fitted language model and the packing cannot be expressed in SQL; the
#: pipeline is tested against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """``documents`` after all stages; each stage's result is written as Parquet
    in the shared folder and read again as the next one's input."""
    tables = Tables(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = tables.save(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
