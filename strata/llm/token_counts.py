"""Token counts through a digest cache.

Texts are known by the digest of their normalised content, tokenizers by the digest of their version. Counts already
stored for a pair of digests are joined; every other distinct text is encoded once and its count appended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from strata.llm.common import append_columns, stored
from strata.llm.vocab import encoder, tokenizer_digest

CACHE_SCHEMA = "content_digest string, tokenizer_digest string, n_tokens bigint"


def normalised(text: Column) -> Column:
    """NULL as empty. Nothing else may change, because every character can change a count."""
    return F.coalesce(text, F.lit(""))


def cached_counts(docs: DataFrame, tokenizer: str, cache: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit``, one row per row of ``docs``; new counts are appended to ``cache``.

    ``tokenizer`` is a vocabulary file of the tokenizers library, ``cache`` a folder that all executors share, made on
    first use. Counts leave out begin, end and added special tokens; texts are never cut. NULL and empty texts have 0
    bytes and tokens. Equal texts are encoded once, however many copies there are; only one copy per task enters the
    shuffle. A cache with the same digest twice (two writers at a time) is read as one entry. NULL ids pass through.
    Other columns of ``docs`` are not looked at. An empty table gives an empty result.
    """
    spark, version = docs.sparkSession, tokenizer_digest(tokenizer)
    text = normalised(F.col(text_col))
    rows = docs.select(F.col(id_col), F.octet_length(text).cast("bigint").alias("n_bytes"), F.sha2(text, 256).alias("content_digest"))
    distinct = docs.select(F.sha2(text, 256).alias("content_digest"), text.alias("content")).groupBy("content_digest").agg(F.first("content").alias("content"))
    try:
        old = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        old = spark.createDataFrame([], CACHE_SCHEMA)
    known = old.where(F.col("tokenizer_digest") == version).groupBy("content_digest").agg(F.max("n_tokens").alias("known"))

    def make():
        coder = encoder(tokenizer)
        return lambda texts: ([len(coder.encode(t)) // coder.dtype.itemsize for t in texts],)

    # Texts with a stored count are emptied before they reach Python.
    looked = distinct.join(known, "content_digest", "left").select(
        "content_digest", "known", F.when(F.col("known").isNull(), F.col("content")).alias("content")
    )
    counted = append_columns(looked, "content", make, drop=("content",), encoded="bigint")
    counts = stored(
        counted.select("content_digest", F.coalesce("known", "encoded").alias("n_tokens"), F.col("known").isNull().alias("new")), "token-counts"
    )
    counts.where("new").select("content_digest", F.lit(version).alias("tokenizer_digest"), "n_tokens").write.mode("append").parquet(cache)
    return rows.join(counts.select("content_digest", "n_tokens"), "content_digest").select(
        id_col, "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
