"""Preparing a training corpus: each stage takes (spark, docs, sf_dir) and returns what its successor reads.

toxicity       documents that the nearest labelled examples call toxic go; all others stay as they are
line dedup     lines that repeat an earlier three-line window go; a document may become empty, but none is dropped
n-gram join    of documents linked by five-word shingles (similarity 0.8 or more) the one of the smallest doc_id stays
mixing         documents appear as often as their source's share of the mix takes them
packing        token pieces and their places in sequences

Every stage but the last returns the columns of its input. Labels are learned from the same rows as in the queries.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from caseloom.llm import line_dedup, mixing, ngram_join, packing, toxicity
from caseloom.llm.common import fold, read, whole_stage


def remove_toxic(spark, docs, sf_dir):
    index = toxicity.fit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "toxic", fold(F.col("doc_id"), 5) != 0)
    return toxicity.without_toxic(docs, index)


def remove_repeated_lines(spark, docs, sf_dir):
    return line_dedup.without_repeated_lines(docs)


def keep_one_near_copy(spark, docs, sf_dir):
    return ngram_join.one_of_each(docs, n=5, num=8, den=10)


def mix_sources(spark, docs, sf_dir):
    return mixing.mixed_documents(docs, read(spark, sf_dir, "labels"))


def pack_tokens(spark, docs, sf_dir):
    return packing.pack(docs, packing.default_tokenizer())


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_repeated_lines),
    ("ngram_join", keep_one_near_copy),
    ("mixing", mix_sources),
    ("packing", pack_tokens),
]
#: Toxicity and packing have no SQL form; tests/llm/test_pipeline.py checks the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = whole_stage(spark, lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
