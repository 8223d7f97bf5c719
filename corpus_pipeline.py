"""A corpus pipeline over `documents`: toxicity, near-duplicates, repeated passages, benchmark passages, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lociframe.llm import bpe_automaton, decontamination, simhash, suffix_dedup, toxicity
from lociframe.llm.queries import table
from lociframe.llm.shared import dropped, small_batches, written

#: Repeated passages go from this many bytes on (about 40 words), or from this many words on.
PASSAGE_BYTES, PASSAGE_WORDS = 250, 51
#: Bytes of text that a task looks for passages in at once; the result does not depend on it, a worker's memory does.
PASSAGE_PIECE = 150_000


def keep_harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5. Null and empty texts score 0 and stay; repeated rows are judged alike; whole texts are
    scored, however long."""
    small_batches(spark)
    net = toxicity.learned(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, net, score="__score").where(F.col("__score") < 0.5).select(*docs.columns)


def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies, exact or near (five-word shingles, similarity of 0.8 or more): that of the least
    doc_id, rows without one last. Null and empty texts are one group; repeated rows are copies; of equal rows any one
    stays."""
    small_batches(spark)
    return simhash.deduplicated(docs, shingle=5, similarity=0.8)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur more than once; n_chars follows the text. Every document stays, if with an
    empty text; a null text stays null, with a null n_chars; all occurrences of a passage go, those of repeated rows too."""
    small_batches(spark)
    cut = suffix_dedup.without_repeats(docs, size=PASSAGE_BYTES, words=PASSAGE_WORDS, kept_text="text", most=PASSAGE_PIECE)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts stay; repeated rows are judged alike; all windows of a text
    are looked at."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))


def count_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the number of their tokens, and digests of the ids and of what they decode to. A null text has none."""
    import public_tokenizers

    small_batches(spark)
    return bpe_automaton.tokenized(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", keep_harmless),
    ("simhash_near_dedup", keep_one_of_copies),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_benchmarks),
    ("bpe_tokens", count_tokens),
]
#: Neither a trained network nor an automaton can be said in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, name)
            if k:
                dropped(before)
    return docs
