"""Near-duplicates by Jaccard similarity of word shingles, found with circulant MinHash.

All coordinates of a signature come from two permutations of a universe of 2 ** 32 places. The first spreads a document's
shingles over the places; the second, turned by k places, gives coordinate k: the least value of it that one of the
shingles has. No further permutations are drawn, so coordinates are cheap, and they are put in bands of several.

Documents with equal sets are one node. Nodes that share a band meet in a task, which links them until none of its pairs
that may be alike is left unlinked or uncompared: sizes and the lowest bits of the signatures must allow the similarity (texts
go only where they do), and it is confirmed on the whole sets of shingles, made again from the whole texts. Pairs that are connected already are
passed over, a pair is looked at in the first band that it shares, and bands of the same nodes are one. Only links leave a
task, fewer than it has nodes.

A band of very many nodes is cut into blocks, and each two blocks meet in a task of their own. Before, its nodes are
compared with a leader of their band that they are not connected to, round after round while that pays, so large groups of
near copies are one component by then and their bands need no blocks at all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import UID, append_columns, arrow_map, numbered, stored, with_text
from strata.llm.components import components

WORDS, PERCENT = 3, 85
# Two sets that share 85 hundredths of their shingles have a band in common but for once in some four million cases;
# sets that share a half of them have one in a sixth of all cases.
BANDS, ROWS = 48, 8
SIGMAS = 6
# Shingles that are looked at together, so that their values stay in a core's cache.
TOGETHER = 512
# Nodes and bytes of text per block of nodes that are compared with each other or with those of another block.
BLOCK_NODES, BLOCK_BYTES = 512, 2 << 20
# Rounds go on while at least one in so many of the pairs compared is a link.
WORTH = 10


def shingles(text: str, words: int = WORDS) -> set[bytes]:
    """Distinct shingles: words are cut at ASCII white space, A-Z lower-cased; fewer words are one shingle, none no set."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return set()
    joined = b" ".join(tokens)
    if len(tokens) <= words:
        return {joined}
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return {joined[a:b] for a, b in zip(starts[: len(ends) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)}


def first_permutation(x: np.ndarray) -> np.ndarray:
    """Where a place of the universe goes: every step can be undone, so no two places go to the same."""
    x = x ^ (x >> np.uint32(16))
    x = x * np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    x *= np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def second_permutation(x: np.ndarray, scratch: np.ndarray) -> None:
    """The same with other steps, in place."""
    for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
        np.right_shift(x, np.uint32(shift), out=scratch)
        np.bitwise_xor(x, scratch, out=x)
        np.multiply(x, np.uint32(factor), out=x)
    np.right_shift(x, np.uint32(16), out=scratch)
    np.bitwise_xor(x, scratch, out=x)


def signature(hashes: np.ndarray, length: int) -> np.ndarray:
    """Coordinate k is the least value of the second permutation turned by k over the places of the shingles."""
    places = first_permutation(hashes.astype(np.uint32))
    turns = np.arange(length, dtype=np.uint32)[:, None]
    least = np.full(length, 0xFFFFFFFF, np.uint32)
    for part in (places[i : i + TOGETHER] for i in range(0, len(places), TOGETHER)):
        values = part + turns  # wraps around: the universe is a circle
        second_permutation(values, np.empty_like(values))
        np.minimum(least, values.min(axis=1), out=least)
    return least


def sketch(text: str, words: int, bands: int, rows: int) -> tuple[int, bytes, np.ndarray, np.ndarray]:
    """Size of a text's set, a digest of the set, a key for every band of its signature, and the lowest bits of it."""
    from xxhash import xxh64_intdigest as digest

    found = shingles(text, words)
    if not found:
        return 0, b"", np.empty(0, np.int64), np.empty(0, np.int64)
    hashes = np.sort(np.fromiter(map(digest, found), np.uint64, len(found)))
    whole = signature(hashes, bands * rows)
    keys = np.fromiter((digest(band.tobytes(), k) for k, band in enumerate(whole.reshape(bands, rows))), np.uint64, bands)
    bits = np.packbits((whole & np.uint32(1)).astype(np.uint8))
    bits = np.pad(bits, (0, -len(bits) % 8)).view(np.int64)
    return len(found), blake2b(hashes, digest_size=16).digest(), keys.view(np.int64), bits


def alike(a: set[bytes], b: set[bytes], percent: int) -> bool:
    shared = len(a & b)
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def most_differing(percent: int, coordinates: int) -> float:
    """Signatures differ in half as many lowest bits as coordinates. Linked pairs differ in more than so many only once in
    more than ten million cases."""
    share = (1 - percent / 100) / 2
    return coordinates * share + SIGMAS * math.sqrt(coordinates * share * (1 - share))


def confirmed(pairs: DataFrame, candidates: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of the pairs ``a, b`` of nodes whose sets are alike, for at most one pair per node ``b``. A node ``a`` may
    have any number of pairs: its text goes to as many tasks as its pairs need."""
    texts = candidates.select("node", "text")
    crowded = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / BLOCK_NODES).alias("parts"))
    firsts = crowded.join(texts.withColumnRenamed("node", "a"), "a").select("a", F.col("text").alias("one"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    spread = pairs.join(crowded, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
    whole = spread.join(texts.withColumnRenamed("node", "b"), "b").join(firsts, ["a", "part"]).select("a", "b", "one", "text")

    def run(batches):
        last, mine = None, set()
        for batch in batches:
            keep = []
            for a, one, other in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                if a != last:
                    last, mine = a, shingles(one, words)
                keep.append(alike(mine, shingles(other, words), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return arrow_map(whole, run, "a bigint, b bigint")


def leaders_links(placed: DataFrame, candidates: DataFrame, words: int, percent: int, coordinates: int, number: int) -> tuple[DataFrame, int]:
    """One round: links of nodes to leaders of their bands, drawn anew in every round, and the number of pairs compared."""
    known = placed.join(candidates.select("node", "n", "bits"), "node")
    drawn = F.xxhash64("node", F.lit(number))
    leaders = known.groupBy("key").agg(F.min(F.struct(drawn.alias("drawn"), "node", "root", "n", "bits")).alias("leader"))
    n, m = F.col("n"), F.col("leader.n")
    words_differ = [F.bit_count(F.col("bits")[k].bitwiseXOR(F.col("leader.bits")[k])) for k in range(math.ceil(coordinates / 64))]
    possible = (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (reduce(Column.__add__, words_differ) <= most_differing(percent, coordinates))
    met = known.join(leaders, "key").where((F.col("root") != F.col("leader.root")) & possible)
    pairs = met.groupBy(F.col("node").alias("b")).agg(F.min_by("leader.node", "leader.drawn").alias("a")).select("a", "b")
    pairs = stored(pairs, "pairs")
    return stored(confirmed(pairs, candidates, words, percent), "links"), pairs.count()


class _Group(dict):
    """Disjoint sets."""

    def find(self, x: int) -> int:
        while (up := self.setdefault(x, x)) != x:
            self[x] = x = self.setdefault(up, up)
        return x


def possible_pairs(rows: list[tuple], cross: bool, percent: int, limit: float) -> np.ndarray:
    """Places of the pairs of rows ``(block, node, root, n, bits, ..)`` that may be alike by sizes and signatures and are not
    connected yet, the likeliest first; with ``cross`` only those of different blocks."""
    blocks, _, roots, sizes, bits = (np.asarray([r[k] for r in rows], np.int64) for k in range(5))
    bits, found = bits.view(np.uint64), []
    for i in range(len(rows) - 1):
        rest = slice(i + 1, None)
        differing = np.bitwise_count(bits[rest] ^ bits[i]).sum(axis=1, dtype=np.int64)
        may = (differing <= limit) & (roots[rest] != roots[i])
        may &= 100 * np.minimum(sizes[rest], sizes[i]) >= percent * np.maximum(sizes[rest], sizes[i])
        if cross:
            may &= blocks[rest] != blocks[i]
        some = np.flatnonzero(may)
        found.append(np.stack([differing[some], np.full(len(some), i), some + i + 1]))
    pairs = np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)
    return pairs[1:, np.argsort(pairs[0], kind="stable")]


def linked_in_block(rows: list[tuple], cross: bool, words: int, percent: int, limit: float) -> list[tuple[int, int]]:
    """Links that connect the nodes ``(block, node, root, n, bits, text)`` of a band wherever pairs of them are alike."""
    group, sets, out = _Group(), {}, []

    def shingled(k: int) -> set[bytes]:
        if k not in sets:
            sets[k] = shingles(rows[k][5], words)
        return sets[k]

    for i, j in possible_pairs(rows, cross, percent, limit).T.tolist():
        x, y = group.find(rows[i][2]), group.find(rows[j][2])
        if x != y and alike(shingled(i), shingled(j), percent):
            group[max(x, y)] = min(x, y)
            out.append((rows[i][1], rows[j][1]))
    return out


def units(batches) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows that follow each other with the same first three values: these values, and the others of all such rows."""
    place, held = None, []
    for batch in batches:
        for now in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now[:3] != place:
                if held:
                    yield place, held
                place, held = now[:3], []
            held.append(now[3:])
    if held:
        yield place, held


def block_links(placed: DataFrame, candidates: DataFrame, words: int, percent: int, coordinates: int) -> DataFrame:
    """``a, b``: links among the nodes of every band of ``key, pos, node, root``."""
    # Bands of the same nodes are one: the first. So the first band that a pair shares is there.
    members = F.struct(F.count(F.lit(1)), F.min("node"), F.sum(F.xxhash64("node").cast("decimal(38,0)")), F.sum(F.hash("node").cast("decimal(38,0)")))
    sized = placed.join(candidates.select("node", F.octet_length("text").alias("bytes")), "node")
    bands = sized.groupBy("key").agg(members.alias("members"), F.min("pos").alias("pos"), F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    bands = bands.groupBy("members").agg(F.min_by(F.struct("key", "n", "bytes"), "pos").alias("band")).select("band.*")
    parts = F.ceil(F.greatest(F.col("n") / BLOCK_NODES, F.col("bytes") / BLOCK_BYTES))
    bands = stored(bands.select("key", F.greatest(parts, F.lit(1)).cast("int").alias("parts")), "bands")
    block = F.pmod(F.hash("node"), F.col("parts"))
    dealt = placed.join(bands, "key").withColumn("block", block).withColumn("met", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    # A band of one block meets itself; of several, a block's own pairs are looked at where it meets itself.
    dealt = dealt.select("key", F.least("block", "met").alias("one"), F.greatest("block", "met").alias("other"), "block", "node", "root")
    limit, order = most_differing(percent, coordinates), ["key", "one", "other"]
    together = lambda df: df.repartition(*order).sortWithinPartitions(*order)

    def narrow(batches):
        for (key, one, other), rows in units(batches):
            pairs = possible_pairs(rows, one != other, percent, limit)
            all_keys = np.asarray([r[5] for r in rows], np.int64)
            some = set()
            for part in (pairs[:, k : k + (1 << 14)] for k in range(0, pairs.shape[1], 1 << 14)):
                same = all_keys[part[0]] == all_keys[part[1]]
                some.update(part[:, all_keys[part[0], same.argmax(axis=1)] == key].ravel().tolist())
            kept = [(key, one, other, *rows[k][:3]) for k in sorted(some)]
            columns = zip(*kept, strict=True) if kept else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    def run(batches):
        for (_, one, other), rows in units(batches):
            found = linked_in_block(rows, one != other, words, percent, limit)
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    # Texts go only where a node has a partner that may be like it, and that it meets in no band before.
    kinds, names = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()], [*order, "block", "node", "root"]
    light = dealt.join(candidates.select("node", "n", "bits", "keys"), "node").select(*order, "block", "node", "root", "n", "bits", "keys")
    needed = stored(arrow_map(together(light), narrow, "key bigint, one int, other int, block int, node bigint, root bigint"), "needed")
    rows = needed.join(candidates.select("node", "n", "bits", "text"), "node").select(*order, "block", "node", "root", "n", "bits", "text")
    return arrow_map(together(rows), run, "a bigint, b bigint")


def links(listed: DataFrame, candidates: DataFrame, words: int, percent: int, coordinates: int) -> DataFrame:
    """``node, root`` of all nodes that are linked. ``listed`` has ``key, pos, node`` for bands that several nodes share,
    ``candidates`` has ``node, n, bits, keys, text`` for these nodes."""
    spark = listed.sparkSession
    found, roots, number = spark.createDataFrame([], "a bigint, b bigint"), spark.createDataFrame([], "node bigint, root bigint"), 0
    while True:
        # Bands whose nodes are all connected have nothing left to tell.
        placed = listed.join(roots, "node", "left").select("key", "pos", "node", F.coalesce("root", "node").alias("root"))
        several = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"))
        several = stored(several.where("low < high").select("key", "n"), "bands-open")
        placed = stored(placed.join(several, "key"), "placed")
        crowded = placed.where(F.col("n") > BLOCK_NODES).drop("n")
        if crowded.isEmpty():
            break
        more, compared = leaders_links(crowded, candidates, words, percent, coordinates, number)
        found, number = stored(found.unionByName(more), "links"), number + 1
        roots = stored(components(found), "roots")
        if more.count() * WORTH < compared or not compared:
            break
        listed = placed.select("key", "pos", "node")
    last = placed.join(roots.withColumnRenamed("root", "now"), "node", "left").select("key", "pos", "node", F.coalesce("now", "node").alias("root"))
    return components(stored(found.unionByName(block_links(last, candidates, words, percent, coordinates)), "links"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``id_col, n_shingles, component_id, kept``, one row per row of ``docs``.

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of ``words``-word shingles; NULL texts
    and texts without words have no set and are linked with nothing. ``component_id`` is the smallest id reachable, the
    document's own included (NULL only where all ids of a component are); ``kept`` tells whether it is the document's own,
    so repeated rows are kept alike. Rows with one id and different texts are different documents. Other columns are not
    looked at. An empty table gives an empty result.
    """
    plain = with_text(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text")

    def make():
        return lambda texts: tuple(zip(*(sketch(t, words, bands, rows) for t in texts), strict=True)) or ([], [], [], [])

    all_rows = stored(numbered(append_columns(plain, "text", make, n="bigint", same="binary", keys="array<bigint>", bits="array<bigint>")), "sketches")
    full = all_rows.where("n > 0")
    # One node per set, numbered by one of its rows.
    nodes = stored(full.groupBy("same").agg(F.min(UID).alias("node"), F.min("id").alias("first")), "nodes")
    chosen = stored(nodes.select(F.col("node").alias(UID)), "chosen")
    own = stored(full.select(UID, "keys").join(chosen, UID, "left_semi"), "own")
    index = own.select(F.col(UID).alias("node"), F.posexplode("keys").alias("pos", "key"))
    shared = stored(index.groupBy("key").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("key"), "shared")
    listed = stored(index.join(shared, "key", "left_semi").select("key", "pos", "node"), "listed")
    meeting = stored(listed.select(F.col("node").alias(UID)).distinct(), "meeting")
    candidates = stored(full.join(meeting, UID, "left_semi").select(F.col(UID).alias("node"), "n", "bits", "keys", "text"), "candidates")
    roots = stored(links(listed, candidates, words, percent, bands * rows), "roots")
    placed = nodes.join(roots, "node", "left").select("same", "first", F.coalesce("root", "node").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(placed.join(least, "root").select("same", "component_id"), "component-ids")
    out = full.select("id", "n", "same").join(named, "same").select("id", "n", "component_id")
    out = out.unionByName(all_rows.where("n = 0").select("id", "n", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
