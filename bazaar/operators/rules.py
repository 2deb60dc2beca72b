"""First-match rules and the accept / quarantine split."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaar.functions import json_row


def first_match(rules: list[tuple[str, Column]]) -> Column:
    """Code of the first rule that is true; a null predicate does not fire, no match gives null."""
    (code, predicate), *others = rules
    return reduce(lambda chain, rule: chain.when(rule[1], F.lit(rule[0])), others, F.when(predicate, F.lit(code)))


def accepted(staged: DataFrame, columns: list[str]) -> DataFrame:
    return staged.filter(F.col("reason_code").isNull()).select(*columns)


def rejected(staged: DataFrame, source: str, quarantine_id: Column) -> DataFrame:
    """Rows with a reason, kept whole as a JSON document."""
    return staged.filter(F.col("reason_code").isNotNull()).select(
        quarantine_id.alias("quarantine_id"),
        F.lit(source).alias("source"),
        "reason_code",
        json_row(staged.columns).alias("payload"),
        F.current_timestamp().alias("quarantined_at"),
    )


def census(staged: DataFrame, sample: str) -> DataFrame:
    """Rows and the smallest sample id per reason."""
    return (
        staged.filter(F.col("reason_code").isNotNull())
        .groupBy("reason_code")
        .agg(F.count("*").alias("row_count"), F.min(sample).alias("sample_id"))
    )
