"""Rows told apart where some have no doc_id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def key() -> Column:
    """doc_id, or for a row without one a number of 2 ** 62 or more made from its text: rows without an id count as one document if their texts are equal."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("text"), 2))


def mark() -> Column:
    """A hash of the text, to tell rows of one doc_id apart."""
    return F.xxhash64("text")


def keyed(docs: DataFrame) -> DataFrame:
    """(row, key, mark): whole rows beside key and mark, so that no column's name can clash; ``row.*`` gives them back."""
    return docs.select(F.struct("*").alias("row"), key().alias("key"), mark().alias("mark"))
