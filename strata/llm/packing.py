"""Best-fit packing of documents into sequences of fixed length, by bin completion.

Only lengths decide a packing, and a length is a number up to the capacity. So the corpus is reduced to one count per
length, however many documents there are; the search works on these counts and gives runs: one filling and how often it
is used. Documents of a length are then numbered in Spark, and number and length lead to run, sequence and offset.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strata.llm.common import UID, arrow_map, numbered, stored, with_text
from strata.llm.vocab import encoder

CAPACITY = 2048
# The search settles for the best packing found after so many nodes, or so many per distinct length where that is more (a
# descent takes about one per length); a node has at most so many branches.
NODES, DESCENTS, FILLINGS = 20_000, 20, 64
# Best fit is tried again where this few lengths are left, and at every so many nodes.
SMALL, RETRY = 40, 100
# Nodes, and fillings built per node, of the second pass.
LONG_FIRST = 3_000, 32
# Pieces of one length that are numbered in one go.
ROWS_PER_COUNTER = 1_000

Filling = tuple[tuple[int, int], ...]  # (length, how often), longest first
Run = tuple[int, Filling]  # (sequences, filling of each)


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> list[Run]:
    """Best fit, longest first, done for all pieces of a length at once.

    Open sequences are groups of equal filling. A piece goes where it leaves the least room; having taken one, a
    sequence is the best fit for the next of the same length as long as that fits.
    """
    open_by_room: dict[int, list[tuple[int, Counter]]] = {capacity: []}

    def put(room: int, n: int, filling: Counter) -> None:
        if n:
            open_by_room.setdefault(room, []).append((n, filling))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        for room in sorted(r for r in open_by_room if length <= r < capacity):
            each = room // length
            groups = open_by_room.pop(room)
            while groups and left:
                n, filling = groups.pop()
                full, rest = divmod(min(left, n * each), each)
                put(room - each * length, full, filling + Counter({length: each}))
                if rest:
                    put(room - rest * length, 1, filling + Counter({length: rest}))
                put(room, n - full - bool(rest), filling)
                left -= full * each + rest
            for n, filling in groups:
                put(room, n, filling)
            if not left:
                break
        each = capacity // length
        full, rest = divmod(left, each)
        put(capacity - each * length, full, Counter({length: each}))
        if rest:
            put(capacity - rest * length, 1, Counter({length: rest}))
    merged: Counter = Counter()
    for groups in open_by_room.values():
        for n, filling in groups:
            merged[tuple(sorted(filling.items(), reverse=True))] += n
    return [(n, f) for f, n in merged.items()]


def least_sequences(counts: dict[int, int], capacity: int) -> int:
    """A lower bound: pieces above ``capacity - k`` go alone, those above half of it one each, and what room the latter
    leave can only take pieces of at least ``k``. The best over all ``k``."""
    lengths = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        lengths[length] = n
    number, total = np.cumsum(lengths), np.cumsum(lengths * np.arange(capacity + 1))
    best, half = -(-int(total[-1]) // capacity), capacity // 2
    for k in range(1, half + 1):
        alone = number[capacity] - number[capacity - k]
        large = number[capacity - k] - number[half]
        room = large * capacity - (total[capacity - k] - total[half])
        best = max(best, int(alone + large + max(0, -(-(int(total[half] - total[k - 1]) - int(room)) // capacity))))
    return best


def long_first(counts: dict[int, int], capacity: int, limit: int) -> list[Filling]:
    """Undominated ways to complete the sequence that holds the longest piece: of those built first the fullest first.

    A filling is dominated if some of its pieces can give way to one left-out piece that is as long or longer and still
    fits: what was taken out fits wherever that piece went. So one piece that fills the rest exactly rules out all
    others. Fillings are built from long pieces to short ones; ``limit`` bounds how many are built.
    """
    longest = max(counts)
    rest = Counter(counts)
    rest[longest] -= 1
    space = capacity - longest
    if rest[space] > 0:
        return [((longest, 2),) if space == longest else ((longest, 1), (space, 1))]
    lengths = sorted((x for x, n in rest.items() if n > 0 and x <= space), reverse=True)
    found: list[Filling] = []
    built = 0

    def dominated(chosen: Counter, room: int) -> bool:
        # A left-out piece replaces chosen ones whose sum is at most its length and at least its length minus the room.
        sums = {0}
        for length, n in chosen.items():
            sums = {s + k * length for s in sums for k in range(n + 1)}
        sums.discard(0)
        own = {length for length, n in chosen.items() if n}
        for s in sums:
            for x in range(s, s + room + 1):
                if rest[x] > chosen[x] and not (x == s and x in own):
                    return True
        return False

    def extend(at: int, room: int, chosen: Counter) -> None:
        nonlocal built
        if built >= limit:
            return
        while at < len(lengths) and lengths[at] > room:
            at = bisect.bisect_left(lengths, -room, at, key=lambda x: -x)
        if at == len(lengths):
            built += 1
            if not dominated(chosen, room):
                found.append(tuple(sorted((chosen + Counter([longest])).items(), reverse=True)))
            return
        length = lengths[at]
        for k in range(min(room // length, rest[length]), -1, -1):
            extend(at + 1, room - k * length, chosen + Counter({length: k}))

    extend(0, space, Counter())
    return sorted(found, key=lambda f: -sum(length * n for length, n in f))


class Left:
    """The pieces not yet packed: a count per length, short lengths first, and the sums that the shorter ones can make."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity, self.lengths = capacity, sorted(counts)
        self.numbers = [counts[x] for x in self.lengths]
        # Bit s of sums[i] is set if pieces of the i shortest lengths add up to s. Right up to sums[valid].
        self.sums, self.valid = [1] * (len(counts) + 1), 0

    def take(self, filling: Filling, times: int) -> None:
        for length, k in filling:
            i = bisect.bisect_left(self.lengths, length)
            self.numbers[i] -= times * k
            self.valid = min(self.valid, i)

    def counts(self) -> dict[int, int]:
        return {length: n for length, n in zip(self.lengths, self.numbers, strict=True) if n}

    def table(self, to: int) -> None:
        mask = (2 << self.capacity) - 1
        for i in range(self.valid, to):
            length, sums = self.lengths[i], self.sums[i]
            left, step = min(self.numbers[i], self.capacity // length), 1
            while left:
                step = min(step, left)
                sums = (sums | sums << step * length) & mask
                left -= step
                step *= 2
            self.sums[i + 1] = sums
        self.valid = max(self.valid, to)

    def ways(self, i: int, total: int) -> Iterator[Filling]:
        """The sets of pieces of the ``i`` shortest lengths that add up to ``total``, long pieces first. No dead ends."""
        if not total:
            yield ()
            return
        i = min(i, bisect.bisect_right(self.lengths, total))
        while i and self.sums[i] >> total & 1:
            i -= 1
            length = self.lengths[i]
            for k in range(min(total // length, self.numbers[i]), 0, -1):
                if self.sums[i] >> total - k * length & 1:
                    for rest in self.ways(i, total - k * length):
                        yield ((length, k), *rest)
                        self.table(i)  # the search has taken pieces and put them back since

    def dominated(self, chosen: Filling, longest: int, room: int) -> bool:
        """A left-out piece replaces chosen ones whose sum is at most its length and at least its length minus the room."""
        own, sums = dict(chosen), {0}
        for length, n in chosen:
            sums = {s + k * length for s in sums for k in range(n + 1)}
        for s in sums - {0}:
            first = bisect.bisect_left(self.lengths, s)
            for i in range(first, bisect.bisect_right(self.lengths, s + room, first)):
                x = self.lengths[i]
                if self.numbers[i] - (x == longest) > own.get(x, 0) and not (x == s and x in own):
                    return True
        return False

    def fillings(self, top: int, limit: int) -> Iterator[Filling | None]:
        """Undominated ways to complete the sequence that holds a piece of the longest length left, ``lengths[top]``, the
        fullest first, among equally full ones long pieces first; ``limit`` at most. None stands for a dominated one.

        A filling is dominated if some of its pieces can give way to one left-out piece that is as long or longer and
        still fits: what was taken out fits wherever that piece went. So one piece that fills the rest exactly rules out
        all others.
        """
        longest = self.lengths[top]
        space, more = self.capacity - longest, self.numbers[top] - 1
        exact = bisect.bisect_left(self.lengths, space, 0, top + 1)
        if space and exact <= top and self.lengths[exact] == space and self.numbers[exact] > (exact == top):
            yield ((longest, 2),) if exact == top else ((longest, 1), (space, 1))
            return
        to = bisect.bisect_right(self.lengths, space, 0, top)
        for total in range(space, -1, -1):
            for same in range(min(total // longest, more), -1, -1):
                self.table(to)
                rest = total - same * longest
                if not self.sums[to] >> rest & 1:
                    continue
                for way in self.ways(to, rest):
                    chosen = ((longest, same), *way) if same else way
                    if self.dominated(chosen, longest, space - total):
                        yield None
                        continue
                    yield ((longest, 1 + same), *way)
                    limit -= 1
                    if not limit:
                        return
                    self.table(to)


def plan(counts: dict[int, int], capacity: int, nodes: int | None = None) -> list[Run]:
    """Runs that pack ``counts`` pieces of each length, in as few sequences as the search finds.

    Best fit is the first incumbent. If it is above the lower bound, a depth-first branch and bound completes sequence
    after sequence around the longest piece left, the fullest first, so its first descent is a second incumbent; a branch
    ends when the room it has wasted rules out fewer sequences than the incumbent. A filling is used as often as the
    counts allow before the next is looked for, and best fit is tried again on what a branch leaves, now and then. The
    search ends at the lower bound or after ``nodes`` nodes. Then a second pass takes fillings of long pieces first, however
    full, as either order finds packings that the other does not.
    """
    counts = {length: n for length, n in counts.items() if n}
    if not counts:
        return []
    nodes = max(NODES, DESCENTS * len(counts)) if nodes is None else nodes
    best = best_fit_decreasing(counts, capacity)
    used, bound, total = sum(n for n, _ in best), least_sequences(counts, capacity), sum(length * n for length, n in counts.items())
    left = Left(counts, capacity)
    limit, built = LONG_FIRST
    passes = [
        (nodes, lambda top: left.fillings(top, FILLINGS)),
        (min(limit, nodes), lambda top: iter(long_first(left.counts(), capacity, built))),
    ]
    for most, fillings in passes:
        path: list[Run] = []
        looked, top = 0, len(counts) - 1
        # Longest length left, fillings to come, sequences and room used up, per run of the path and one for its end.
        open_nodes = [(top, fillings(top), 0, 0)]
        while open_nodes and used > bound and looked < most:
            top, branches, taken, room = open_nodes[-1]
            filling = next(branches, ()) if -(-(total + room) // capacity) < used else ()
            if filling == ():
                open_nodes.pop()
                if path:
                    times, filling = path.pop()
                    left.take(filling, -times)
                continue
            looked += 1
            if filling is None:
                continue
            times = min(left.numbers[bisect.bisect_left(left.lengths, length)] // k for length, k in filling)
            wasted = room + times * (capacity - sum(length * k for length, k in filling))
            if -(-(total + wasted) // capacity) >= used:
                continue
            left.take(filling, times)
            path.append((times, filling))
            taken += times
            while top >= 0 and not left.numbers[top]:
                top -= 1
            if top < 0:
                best, used = list(path), taken
            elif looked % RETRY == 0 or sum(map(bool, left.numbers)) <= SMALL:
                rest = best_fit_decreasing(left.counts(), capacity)
                if taken + sum(n for n, _ in rest) < used:
                    best, used = [*path, *rest], taken + sum(n for n, _ in rest)
            open_nodes.append((top, fillings(top) if top >= 0 else iter(()), taken, wasted))
        for times, filling in path:
            left.take(filling, -times)
    return best


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: every document's ids and ``end_id``, cut where longer than a sequence."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    arrow = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer)
        end = np.asarray([end_id], coder.dtype).tobytes()
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(coder.encode(text) + end, coder.dtype).astype("<u4")
                for k, start in enumerate(range(0, len(ids), capacity)):
                    piece = ids[start : start + capacity]
                    for column, value in zip(out, (doc, k, start, len(piece), zlib.crc32(piece)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, arrow, strict=True)], names)

    plain = with_text(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")), "text")
    return arrow_map(plain, cut, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, one row per piece.

    Documents up to ``capacity`` tokens (end id included) are never cut; longer ones give pieces of ``capacity`` and a
    last one that may be shorter. NULL and empty texts are a piece of one token. Repeated rows and NULL ids are packed
    like any other. Sequences have no gaps; their numbers are 0 to n-1. An empty table gives an empty result. Other
    columns of ``docs`` are not looked at.
    """
    spark = docs.sparkSession
    cut = stored(numbered(pieces(docs, tokenizer, end_id, capacity, id_col, text_col)), "pieces")
    # At most one row per length.
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = plan(counts, capacity)

    # Where each length is used: numbers from `first` on, `each` to a sequence, the first of them at `at`.
    next_number: Counter = Counter()
    spans, sequence = [], 0
    for n, filling in runs:
        at = 0
        for length, each in filling:
            spans.append((length, next_number[length], sequence, each, at))
            next_number[length] += n * each
            at += length * each
        sequence += n
    spans.sort()
    table = np.asarray(spans, np.int64).reshape(-1, 5)
    shift = 44  # numbers of one length stay below 2 ** 44
    keys = (table[:, 0] << shift) | table[:, 1]

    counters = spark.createDataFrame(
        [(length, max(1, -(-n // ROWS_PER_COUNTER))) for length, n in sorted(counts.items())], "length bigint, counters bigint"
    )
    dealt = cut.join(F.broadcast(counters), "length").withColumn("counter", F.pmod(F.xxhash64(UID), F.col("counters"))).drop("counters")
    before = Window.partitionBy("length").orderBy("counter").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("length", "counter")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("length", "counter", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    place = Window.partitionBy("length", "counter").orderBy("doc_id", "piece", UID)
    ranked = (
        dealt.withColumn("place", F.row_number().over(place))
        .join(offsets, ["length", "counter"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place") - 1).alias("number"))
    )

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            span = table[np.searchsorted(keys, (length << shift) | number, "right") - 1]
            index = number - span[:, 1]
            made = [span[:, 2] + index // span[:, 3], span[:, 4] + index % span[:, 3] * length]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], *map(pa.array, made)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            )

    return arrow_map(
        ranked, lay, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )
