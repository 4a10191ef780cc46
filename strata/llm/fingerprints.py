"""Document fingerprints by consistent weighted sampling, in DataFrame functions alone.

A document is its words with their counts as weights. For each of K samples every word draws three numbers from its
hash: r and c from a Gamma(2, 1) distribution, b uniform. With weight s, t = floor(ln s / r + b) and
ln a = ln c - r (t - b + 1); the word with the least a is the sample, together with t. Two documents give the same
sample with the probability of their generalised Jaccard similarity, sum of least over sum of greatest weights, so the
share of equal samples estimates it.

Words are counted where the document lies, and samples are reduced to their least there too; what travels is one row per
document. A document and its edited text are sampled together, because they share most words and every draw.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import stored

SAMPLES = 32
# A sample is packed into one long: the level of a in the upper bits, word and t in the lower 29. Of a sample 16 bits
# are kept in a fingerprint, so two different samples look equal once in 65536 times.
LEVEL_OFFSET, LEVEL_SCALE, ID_BITS, KEPT_BITS = 256.0, float(1 << 24), 29, 16
NONE = (1 << 63) - 1
# Documents that are counted by one task.
DOCS_PER_TASK = 2_000


def words(text: Column) -> Column:
    """The words between ASCII white space, repeats included; a run of white space leaves empty ones."""
    spaced = reduce(lambda c, space: F.replace(c, F.lit(space), F.lit(" ")), "\t\n\x0b\x0c\r", text)
    return F.split(spaced, " ")


def _uniform(bits: str, shift: int, width: int) -> str:
    return f"(((shiftrightunsigned({bits}, {shift}) & {(1 << width) - 1}L) + 0.5D) / {1 << width}D)"


def sampled(term: str, weight: str, k: int) -> Column:
    """The k-th sample of a word as a long in the order of a; greater than all others where the weight is 0."""
    x = f"xxhash64({term}, {k})"
    y = f"xxhash64({x})"
    r = f"(-ln({_uniform(x, 0, 32)} * {_uniform(x, 32, 32)}))"
    log_c = f"ln(-ln({_uniform(y, 0, 21)} * {_uniform(y, 21, 21)}))"
    b = _uniform(y, 42, 21)
    t = f"floor(log_{weight} / {r} + {b})"
    level = f"cast(greatest({log_c} - {r} * ({t} - {b} + 1D) + {LEVEL_OFFSET}D, 0D) * {LEVEL_SCALE}D as bigint)"
    identity = f"(({y} ^ {t}) & {(1 << ID_BITS) - 1}L)"
    # Not a condition: the draws of a word are then worked out once for both of its weights.
    return F.expr(f"greatest(shiftleft({level}, {ID_BITS}) | {identity}, no_{weight})")


def _short(least: str) -> str:
    """What a fingerprint keeps of a sample; 0 for a text without words."""
    return f"cast(if({least} < {NONE}L, {least} & {(1 << KEPT_BITS) - 1}L, 0L) as int)"


def signatures(texts: DataFrame, keys: list[str], columns: tuple[str, ...], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and per text column an array of samples of the same name.

    ``texts`` has one row per combination of ``keys`` and must be partitioned by them, so that counting needs no
    shuffle. A row without any word gives 0 for all samples.
    """
    pair = F.array(*[F.struct(F.lit(i).alias("of"), words(F.col(c)).alias("words")) for i, c in enumerate(columns)])
    each = texts.select(*keys, F.explode(pair).alias("text")).select(*keys, "text.of", F.explode("text.words").alias("word"))
    counted = each.groupBy(*keys, F.when(F.col("word") != "", F.xxhash64("word")).alias("term")).agg(
        *[F.count_if(F.col("of") == i).alias(f"w{i}") for i in range(len(columns))]
    )
    weighed = counted.select(
        *keys, "term",
        *[F.log(F.greatest(F.col(f"w{i}"), F.lit(1)).cast("double")).alias(f"log_w{i}") for i in range(len(columns))],
        *[F.when((F.col(f"w{i}") > 0) & F.col("term").isNotNull(), F.lit(0)).otherwise(F.lit(NONE)).alias(f"no_w{i}") for i in range(len(columns))],
    )
    least = weighed.groupBy(*keys).agg(*[F.min(sampled("term", f"w{i}", k)).alias(f"s{i}_{k}") for k in range(samples) for i in range(len(columns))])
    return least.select(*keys, *[F.expr(f"array({', '.join(_short(f's{i}_{k}') for k in range(samples))})").alias(c) for i, c in enumerate(columns)])


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """The share of equal samples."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / float(samples)


def printed(signature: Column) -> Column:
    """Four hexadecimal digits a sample."""
    return F.array_join(F.transform(signature, lambda s: F.lpad(F.lower(F.hex(s)), 4, "0")), "")


def next_documents(ids: DataFrame) -> DataFrame:
    """``k1, k2, n1, n2`` and all other columns: the document behind each in ascending order of ``doc_id`` (NULL first)
    and key, the first one behind the last. Whole ranges are ordered by tasks of their own, and joined at their ends."""
    order = ["doc_id", "k1", "k2"]
    ranged = stored(ids.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("range", F.spark_partition_id()), "order")
    this = F.struct("k1", "k2")
    following = ranged.withColumn("next", F.lead(this).over(Window.partitionBy("range").orderBy(*order)))
    # One row per range from here to the join.
    firsts = ranged.groupBy("range").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), *order)).alias("first"))
    firsts = stored(firsts.select("range", F.struct("first.k1", "first.k2").alias("first")), "order-ends")
    by_range = Window.orderBy("range")
    opening = F.first("first").over(by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ends = firsts.select("range", F.coalesce(F.lead("first").over(by_range), opening).alias("after"))
    joined = following.join(ends, "range").withColumn("next", F.coalesce("next", "after"))
    return joined.select(*ids.columns, F.col("next.k1").alias("n1"), F.col("next.k2").alias("n2"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``, one row per row.

    The edited text is the text with its last quarter of characters (rounded down) replaced by as many from the start
    of the next document, or all it has. Documents are in ascending order of id, NULL first; rows with the same id are
    in order of a digest, and rows with the same id and text count as one document, of which every row gets the result.
    A single document is its own next. NULL texts count as empty; texts without words have a fingerprint of zeros and
    are like each other. Equal texts have equal fingerprints. Other columns are not looked at. An empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    whole = F.sha2(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit(":"), text), 256)
    # 120 bits of the digest of id and text, as two numbers.
    keys = [F.conv(F.substring("digest", start, 15), 16, 10).cast("bigint").alias(name) for start, name in ((1, "k1"), (16, "k2"))]
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), whole.alias("digest")).select("doc_id", "text", *keys)

    rows = stored(base.select("doc_id", "k1", "k2", F.length("text").cast("bigint").alias("n_chars")), "documents")
    unique = rows.groupBy("k1", "k2").agg(F.min("doc_id").alias("doc_id"), F.min("n_chars").alias("n_chars"))
    chain = stored(next_documents(unique), "documents-next").withColumn("cut", F.floor(F.col("n_chars") / 4).cast("int"))

    tasks = max(1, -(-chain.count() // DOCS_PER_TASK), int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Both joins read the texts from one exchange.
    texts = base.repartition(tasks, "k1", "k2").dropDuplicates(["k1", "k2"]).select("k1", "k2", "text")
    wanted = chain.select(F.col("n1").alias("k1"), F.col("n2").alias("k2"), F.col("k1").alias("o1"), F.col("k2").alias("o2"), "cut")
    heads = texts.join(wanted.repartition(tasks, "k1", "k2"), ["k1", "k2"])
    heads = heads.select(F.col("o1").alias("k1"), F.col("o2").alias("k2"), "cut", F.expr("left(text, cut)").alias("head"))
    edited = texts.join(heads.repartition(tasks, "k1", "k2"), ["k1", "k2"]).select(
        "k1", "k2", "text", F.concat(F.expr("left(text, length(text) - cut)"), "head").alias("edited")
    )
    signed = signatures(edited.withColumn("edited_sha256", F.sha2("edited", 256)), ["k1", "k2", "edited_sha256"], ("text", "edited"), samples)
    signed = stored(signed, "signatures")

    after = signed.select(F.col("k1").alias("n1"), F.col("k2").alias("n2"), F.col("text").alias("next"))
    known = signed.join(chain.select("k1", "k2", "n1", "n2"), ["k1", "k2"]).join(after, ["n1", "n2"])
    result = stored(
        known.select(
            "k1", "k2", "edited_sha256", printed(F.col("text")).alias("fingerprint"), printed(F.col("edited")).alias("edited_fingerprint"),
            likeness(F.col("text"), F.col("edited"), samples).alias("near_edited"), likeness(F.col("text"), F.col("next"), samples).alias("near_next"),
        ),
        "fingerprints",
    )
    return rows.join(result, ["k1", "k2"]).drop("k1", "k2")
