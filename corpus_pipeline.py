"""A training corpus from raw documents: toxic texts go, repeated lines and near copies go, sources are mixed, and what
is left is packed into token sequences. Each stage is one operator of bazaar.llm over all that its predecessor kept.

Defined cases: null and blank texts are no lines and no near copies of each other; they pass the first three stages, the mix
takes none of them, as they have no words. Rows without doc_id match nothing and stay until the mix. Rows that share a
doc_id are told apart by their text; of equal rows one stays. Further columns, whatever their names, pass through the
first four stages. An empty table gives no piece, and so does a table without any words.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bazaar.llm import jaccard, lines, mixing, packing, toxicity
from bazaar.llm.common import saved
from bazaar.llm.queries import ready, table

#: Near copies: shingles of five words, Jaccard 0.8 or more.
SHINGLE, PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from these documents and their labels, does not call toxic."""
    return toxicity.without_toxic(docs, table(ready(spark), sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of lines go, and documents that consist of nothing else."""
    ready(spark)
    return lines.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    ready(spark)
    return jaccard.one_of_each(docs, SHINGLE, PERCENT)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: a document comes as often as the mix takes it."""
    ready(spark)
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in the sequences."""
    ready(spark)
    return packing.packed(docs, packing.vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]

#: Tokenizer ids, a fitted classifier and random draws are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each one's rows are written and read again by the next."""
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
