"""Near-duplicates by SimHash, found through an inverted index over byte positions with count filtering.

A fingerprint has eight bytes. If two differ in at most `d` bits they agree in at least `8 - d` bytes: with four bits, in
four. Lists of a single byte at a position would each hold a 256th of all fingerprints, so the index lists them under the
bytes at sets of positions, one position fewer than are guaranteed: for four bits under 56 sets of three. Pairs that meet
in a list share at least three bytes; the shared positional bytes of each are tallied, pairs below the guaranteed number
are dropped (most of those that meet by chance share three only), each pair is kept under the first set that it shares,
and the bits are verified.

Fingerprints are indexed once however many documents have them. A posting list that is long (many fingerprints close to
each other) is not turned into pairs: each of its fingerprints is listed under every value within half the distance, and
all that meet under a value are within the distance of each other, so one link each to the smallest is enough to connect
them. Any two within the distance meet under some value half-way. Work on a list grows with its length, not its square.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import UID, append_columns, numbered, positional, stored
from strata.llm.components import components

BYTES, BITS, SEED = 8, 64, 42
# Posting lists longer than this go by half-way values. A member of such a list costs 2081 shuffled rows; as one of n in
# each of 56 lists it costs 28 n comparisons, each about a tenth of a row, so lists of some hundreds are cheaper as pairs.
LONG_LIST = 512


def shingle_hashes(text: str, words: int) -> list[int]:
    """XXH64 of every shingle, repeats included: words are cut at ASCII white space, A-Z lower-cased."""
    from xxhash import xxh64_intdigest as digest

    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return []
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return [digest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return [digest(joined[a:b], SEED) for a, b in zip(starts[: len(ends) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)]


def fingerprint(text: str, words: int = 4) -> int:
    """A bit is set if it is set in more than half of the hashes; no words give zero."""
    hashes = shingle_hashes(text, words)
    if not hashes:
        return 0
    value = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = np.asarray(hashes[i : i + (1 << 14)], "<u8").view(np.uint8).reshape(-1, BYTES)
        value += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * value > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprinted(docs: DataFrame, text_col: str = "text", words: int = 4, column: str = "__fp") -> DataFrame:
    """Adds the fingerprint as a signed long."""

    def make():
        return lambda texts: (np.fromiter((fingerprint(t, words) for t in texts), np.uint64, len(texts)).view(np.int64),)

    return append_columns(docs, text_col, make, **{column: "bigint"})


def _byte(value: Column, position: int) -> Column:
    return F.shiftrightunsigned(value, 8 * position).bitwiseAND(F.lit(255))


def _sets(max_bits: int) -> list[tuple[int, ...]]:
    """Sets of byte positions under which fingerprints are listed, in order."""
    if not 0 <= max_bits < BYTES:
        raise ValueError("a pair must be sure to share a byte: max_bits is 0 to 7")
    return list(combinations(range(BYTES), max(BYTES - max_bits - 1, 1)))


def _index(fingerprints: DataFrame, max_bits: int) -> DataFrame:
    """``fp, key``: every fingerprint under the bytes at each set of positions, with the number of the set above them."""
    keys, fp = [], F.col("fp")
    for k, s in enumerate(_sets(max_bits)):
        parts = [F.shiftleft(_byte(fp, p), 8 * i) for i, p in enumerate(s)]
        # Sets of seven positions leave one byte for the number, which is enough: there are eight.
        keys.append(reduce(Column.bitwiseOR, [*parts, F.lit(k << 8 * len(s))]))
    # Few bytes become many rows here, so the fingerprints are spread over all tasks before.
    tasks = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fingerprints.repartition(tasks, "fp").select("fp", F.explode(F.array(*keys)).alias("key"))


def _agreement(a: Column, b: Column) -> list[Column]:
    """Per position, whether both fingerprints have the same byte there."""
    change = a.bitwiseXOR(b)
    return [_byte(change, p) == 0 for p in range(BYTES)]


def _tally(a: Column, b: Column) -> Column:
    """The number of positional bytes that two fingerprints share."""
    return reduce(Column.__add__, [c.cast("int") for c in _agreement(a, b)])


def _met(listed: DataFrame, max_bits: int) -> DataFrame:
    """``a, b``: all pairs that meet in a list, once each, under the first set that they share."""
    sets = _sets(max_bits)
    x, y = listed.alias("x"), listed.alias("y")
    a, b = F.col("x.fp"), F.col("y.fp")
    agree = _agreement(a, b)
    first = F.coalesce(*[F.when(reduce(Column.__and__, [agree[p] for p in s]), F.lit(k)) for k, s in enumerate(sets)])
    own = F.shiftrightunsigned(F.col("x.key"), 8 * len(sets[0]))
    return x.join(y, (F.col("x.key") == F.col("y.key")) & (a < b)).where(first == own).select(a.alias("a"), b.alias("b"))


def links(fingerprints: DataFrame, max_bits: int = 4, long_list: int = LONG_LIST) -> DataFrame:
    """``a, b``: links between the values of column ``fp`` (distinct, long) that connect all within ``max_bits`` bits."""
    index = _index(fingerprints, max_bits)
    lists = stored(index.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "postings")

    listed = stored(index.join(lists.where(F.col("n") <= long_list).select("key"), "key"), "postings-short")
    a, b = F.col("a"), F.col("b")
    counted = _met(listed, max_bits).where(_tally(a, b) >= BYTES - max_bits)
    pairs = counted.where(F.bit_count(a.bitwiseXOR(b)) <= max_bits)
    crowded = index.join(lists.where(F.col("n") > long_list).select("key"), "key").select("fp").distinct()
    return pairs.unionByName(_crowded_links(crowded, max_bits))


def _crowded_links(crowded: DataFrame, max_bits: int) -> DataFrame:
    """Links among fingerprints of long lists, by values half-way.

    At most as many fingerprints meet under a value as there are values within the larger half of the distance, 2081
    for four bits. With an odd distance all are linked to the smallest that is within the smaller half.
    """
    near, far = max_bits // 2, max_bits - max_bits // 2
    flips = [sum(1 << b for b in c) for n in range(far + 1) for c in combinations(range(BITS), n)]
    flips = [f - (1 << 64) if f >= 1 << 63 else f for f in flips]
    table = F.from_json(F.lit(str(flips)), "array<bigint>")
    way = crowded.select("fp", F.explode(table).alias("flip"))
    meet = way.groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("value")).agg(
        F.min(F.when(F.bit_count("flip") <= near, F.col("fp"))).alias("a"), F.collect_list("fp").alias("all")
    )
    met = meet.where((F.size("all") > 1) & F.col("a").isNotNull())
    return met.select("a", F.explode("all").alias("b")).where("a != b").distinct()


def _labels(rows: DataFrame, max_bits: int, long_list: int) -> DataFrame:
    """``__fp, root``: for every fingerprint one of those it is connected to, the same for all of them."""
    fps = stored(rows.select(F.col("__fp").alias("fp")).distinct(), "fingerprints")
    roots = components(links(fps, max_bits, long_list))
    return stored(
        fps.join(roots, fps["fp"] == roots["node"], "left").select(F.col("fp").alias("__fp"), F.coalesce("root", "fp").alias("root")), "fingerprints"
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4, long_list: int = LONG_LIST
) -> DataFrame:
    """``id_col, fingerprint, component_id``, one row per row of ``docs``.

    Fingerprints are linked at ``max_bits`` or fewer differing bits; ``component_id`` is the smallest id reachable, the
    document's own included (NULL only where all ids of a component are). Equal fingerprints are linked, those without
    words (zero) too. NULL texts count as empty. Other columns are not looked at. An empty table gives an empty result.
    """
    rows = stored(fingerprinted(docs.select(id_col, text_col), text_col, words).drop(text_col), "fingerprints")
    labels = _labels(rows, max_bits, long_list)
    own = rows.groupBy("__fp").agg(F.min(id_col).alias("first"))
    least = own.join(labels, "__fp").groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(labels.join(least, "root").select("__fp", "component_id"), "component-ids")
    return rows.join(named, "__fp").select(id_col, F.lpad(F.lower(F.hex("__fp")), 16, "0").alias("fingerprint"), "component_id")


def without_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4, long_list: int = LONG_LIST
) -> DataFrame:
    """The rows of ``docs`` without all but one of each component, with all their columns: the smallest id stays (NULL
    last), then the row read first."""
    plain, (doc_id, text) = positional(docs, id_col, text_col)
    rows = stored(numbered(fingerprinted(plain, text, words)), "fingerprints")
    labels = _labels(rows, max_bits, long_list)
    members = rows.select(UID, F.col(doc_id).alias("id"), "__fp").join(labels, "__fp")
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col(UID).alias("uid"))
    kept = members.groupBy("root").agg(F.min(order).alias("best")).select(F.col("best.uid").alias(UID))
    return rows.join(kept, UID, "left_semi").select(*plain.columns).toDF(*docs.columns)
