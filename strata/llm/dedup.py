"""Exact deduplication by distributed radix partitioning, most significant bytes first.

Documents are split by the first bytes of their normalised text, every group that still holds more than one is split by
the next bytes, and so on until a group is a single document or its texts have ended. Two texts that end together in
one group are equal byte for byte; no digest is compared. A round reads wider slices than the one before, so a text of
n bytes needs about log(n) rounds.

Groups may be of any size: members are counted before the shuffle, and the join that hands each document its new group
is one that Spark splits where a group is large.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import UID, discard, numbered, positional, stored
from strata.session import scratch_path

WHITE_SPACE = " \t\n\x0b\x0c\r"
# Bytes of the first slice, and how many times wider each following slice is.
FIRST_SLICE, WIDER = 64, 16


def normalised(text: Column) -> Column:
    """The text without white space; NULL as empty."""
    return reduce(lambda c, space: F.replace(c, F.lit(space)), WHITE_SPACE, F.coalesce(text, F.lit("")))


def groups_of_equals(rows: DataFrame, release: Callable[[], None] = lambda: None) -> DataFrame:
    """``__uid, gid`` of the rows whose binary ``content`` equals another's; ``gid`` is the smallest number of a group.

    ``rows`` must give the same numbers whenever it is read. ``release`` is called when it is not needed any more.
    """

    def part(start: int, width: int) -> Column:
        return F.substring("content", start + 1, width).alias("slice")

    def split(slices: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
        """One round: the documents that have ended in company, and those that need another slice."""
        parts = slices.groupBy("gid", "slice").agg(F.min(UID).alias("new"), F.count(F.lit(1)).alias("n"))
        parts = stored(parts.where("n > 1").drop("n"), "radix-groups")
        state = slices.join(parts, ["gid", "slice"]).select(UID, F.col("new").alias("gid"), (F.length("slice") < width).alias("ended"))
        state = stored(state, "radix-state")
        return state.where("ended").drop("ended"), state.where("NOT ended").drop("ended")

    start, width = 0, FIRST_SLICE
    # The first round reads one slice of every row; only rows that share theirs travel with their whole text.
    ended, going = split(rows.select(UID, F.lit(0).cast("bigint").alias("gid"), part(start, width)), width)
    shared = stored(rows.select(UID, "content").join(going.select(UID), UID), "radix-rows")
    release()
    while not going.isEmpty():
        start, width = start + width, width * WIDER
        slices = stored(shared.select(UID, part(start, width)).join(going, UID), "radix-slices")
        more, going = split(slices, width)
        ended = ended.unionByName(more)
    return ended


def decisions(rows: DataFrame, release: Callable[[], None] = lambda: None) -> DataFrame:
    """``__uid, doc_id, keep_id, group_size, kept, text_sha256`` for rows ``__uid, doc_id, chars, content``."""
    own = stored(rows.select(UID, "doc_id", "chars", F.sha2("content", 256).alias("text_sha256")), "radix-own")
    groups = groups_of_equals(rows, release)
    members = stored(own.join(groups, UID, "left").withColumn("gid", F.coalesce("gid", UID)), "radix-members")
    # Partly aggregated where the rows lie: a group of any size is one row per task in the shuffle.
    order = F.struct((-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"), F.col(UID).alias("uid"))
    best = members.groupBy("gid").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("size")).where("size > 1")
    best = stored(best.select("gid", "size", F.col("best.doc_id").alias("keep"), F.col("best.uid").alias("keep_uid")), "radix-best")
    alone = F.col("size").isNull()
    return members.join(best, "gid", "left").select(
        UID,
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
        (alone | (F.col(UID) == F.col("keep_uid"))).alias("kept"),
        "text_sha256",
    )


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(UID, F.col(id_col).alias("doc_id"), F.length(text).alias("chars"), normalised(text).cast("binary").alias("content"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256``, one row per row of ``docs``.

    Texts are equal when they are the same after deleting the six ASCII white-space characters; NULL counts as empty.
    Of equal texts the row with the most characters stays, then the smallest id (NULL last), then the row read first;
    so of repeated rows one stays. Other columns are not looked at. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "radix-input")
    rows = stored(_rows(numbered(docs.select(id_col, text_col)), id_col, text_col), "radix-input", path)
    return decisions(rows, lambda: discard(spark, path)).drop(UID)


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    plain, (doc_id, text) = positional(docs, id_col, text_col)
    rows = stored(numbered(plain), "radix-input")
    dropped = decisions(_rows(rows, doc_id, text)).where("NOT kept").select(UID)
    return rows.join(dropped, UID, "left_anti").drop(UID).toDF(*docs.columns)
