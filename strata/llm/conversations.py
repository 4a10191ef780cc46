"""Repair of the structure of conversations by iterative-deepening A*.

A conversation is sound if the initials of its roles read ``(s?(ua)+)?``. Rows are kept, rerolled or deleted, and empty
rows inserted; the cheapest edits win, and of equally cheap ones the ASCII-least string of their initials. The search
tries edits in ASCII order depth first, under a bound on the cost that grows to the next cost that could not be ruled
out; a table of failed states holds what is known to be missing to the goal from each state, so no state fails twice for
the same reason. So the first path that reaches the goal is the answer.

No conversation need fit a task. Rows are put in order over all tasks and cut into blocks; each block is searched from
every state it may begin in to every state it may end in, apart from all others; and blocks are put together by their
costs. Every edit string of a block has one letter other than I per row and ends in such a letter (an insertion belongs
to the row behind it), so none is the beginning of another, and the least string of a whole is made of least strings of
its parts.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import arrow_map, stored

# Costs of edits, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# White space, and the ends of sentences.
BLANKS, ENDS = " \t\n\x0b\f\r", ".!?"
# Rows of a conversation searched in one go.
BLOCK = 64

# What was read: nothing, s alone, up to a u, up to an a. The first and last are sound ends.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEVER = 1 << 60
# State after a kept row, by state and the row's initial; and after a row of the role that the state waits for.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
WANTED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
# Least cost from a state to a sound end without further rows, and the letters of it.
ENDING = {START: (0, ""), SYSTEM: (2 * INSERT, "II"), USER: (INSERT, "I"), ASSISTANT: (0, "")}

# A row is written as one letter: its initial (s, u, a, or x for all others), upper case where it is truncated, or "-"
# where it must be deleted.
Symbols = str


def _least(symbol: str) -> int:
    """No edit of the row costs less."""
    return DELETE if symbol == "-" or symbol.isupper() else REROLE if symbol == "x" else 0


@functools.lru_cache(maxsize=200_000)
def repair(symbols: Symbols, begin: int, end: int) -> tuple[int, str] | None:
    """Cost and initials of the cheapest, then ASCII-least edits of the rows that lead from state ``begin`` to ``end``,
    with insertions before rows only; None where no edits do."""
    if (end == START != begin) or (end == SYSTEM and begin not in (START, SYSTEM)) or (end == SYSTEM != begin and "s" not in symbols.lower()):
        return None  # nothing leads back to these states, and s can't be inserted
    n = len(symbols)
    rest = [0] * (n + 1)
    for i in reversed(range(n)):
        rest[i] = rest[i + 1] + _least(symbols[i])
    # The least cost to the goal that is not ruled out yet, by row and state: more than the heuristic where a search failed.
    known: dict[tuple[int, int], int] = {}
    path: list[str] = []

    def missing(i: int, state: int) -> int:
        if i == n:
            return 0 if state == end else NEVER
        return known.get((i, state), rest[i])

    def search(i: int, state: int, budget: int, inserted: int) -> int:
        """0 if the goal is within the budget, and then ``path`` leads there; else what is missing at least."""
        if (least := missing(i, state)) > budget:
            return least
        if i == n:
            return 0
        symbol, least = symbols[i], NEVER
        extra = TRUNCATED if symbol.isupper() else 0
        # D, I, K, R: the order of ASCII.
        steps = [("D", i + 1, state, DELETE)]
        if inserted < 2:  # a third insertion leads where one has led
            steps.append(("I", i, WANTED[state], INSERT))
        if symbol != "-":
            kept = KEPT.get((state, symbol.lower()))
            if kept is not None:
                steps.append(("K", i + 1, kept, KEEP + extra))
            steps.append(("R", i + 1, WANTED[state], REROLE + extra))
        for letter, to, after, cost in steps:
            lacking = missing(to, after)
            if lacking + cost <= budget:
                path.append(letter)
                lacking = search(to, after, budget - cost, inserted + 1 if letter == "I" else 0)
                if not lacking:
                    return 0
                path.pop()
            least = min(least, cost + lacking)
        if not inserted:
            known[i, state] = least
        return least

    bound = missing(0, begin)
    while lacking := search(0, begin, bound, 0):
        bound = lacking
    return bound, "".join(path)


def stitched(blocks: list[list[tuple[int, str] | None]]) -> tuple[int, str]:
    """Cost and initials of a conversation from its blocks, each with an answer per begin and end state (in a row)."""
    left = [ENDING[s][0] for s in STATES]
    costs = [left]
    for block in reversed(blocks):
        left = [min((a[0] + left[e] for e in STATES if (a := block[4 * b + e]) is not None), default=NEVER) for b in STATES]
        costs.append(left)
    costs.reverse()
    state, out = START, []
    for block, after in zip(blocks, costs[1:], strict=True):
        answers = [(a, e) for e in STATES if (a := block[4 * state + e]) is not None]
        least = min(a[0] + after[e] for a, e in answers)
        edits, state = min((a[1], e) for a, e in answers if a[0] + after[e] == least)
        out.append(edits)
    out.append(ENDING[state][1])
    return costs[0][START], "".join(out)


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, turn, role, text`` after damage by crc32(``conv:turn``) % 20: 0 drops a row, 1 empties its text, 2 removes its
    sentence ends, 3 repeats it, 4 makes it a user's. NULL is one space, in the checksum too; a NULL turn stays NULL."""
    space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(F.col(conv)), F.lit(":"), space(F.col(turn))).cast("binary")) % 20
    words = space(F.col(text))
    rows = df.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(space(F.col(role))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(words, ENDS, "")).otherwise(words).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )
    return rows.where("times > 0").withColumn("copy", F.explode(F.expr("sequence(1, times)"))).drop("times", "copy")


def judged(rows: DataFrame) -> DataFrame:
    """Rows of one and the same conversation, turn, role and text as one, with their number ``copies``, a digest of role and
    text, the initial, and whether the text is blank or truncated; ``again`` tells that a row before them says the same."""
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))
    alike = stored(rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies")).withColumn("digest", digest), "turns")
    # The first turn of each text that a conversation has in several: aggregated before the shuffle.
    key = F.struct("conv", "digest")
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    repeated = alike.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).where("n > 1").select("key", "first")
    body = F.rtrim("text", F.lit(BLANKS))
    last, initial = F.expr("right(__body, 1)"), F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise(F.lit("x"))
    return (
        alike.join(repeated, key == F.col("key"), "left")
        .withColumn("__body", body)
        .withColumn("again", F.col("first").isNotNull() & (order != F.col("first")))
        .withColumn("blank", F.col("__body") == "")
        .withColumn("truncated", ~last.isin(*ENDS))
        .select("conv", "turn", "role", "text", "copies", "digest", letter.alias("initial"), "blank", "again", "truncated")
    )


BLOCKS = (
    "conv {conv}, task int, number int, first_turn {turn}, last_turn {turn}, least_turn {turn}, turns bigint, first string, last string,"
    " blank bigint, duplicate bigint, truncated bigint, illegal bigint, costs array<int>, edits array<string>"
)
LEGAL = {"su", "ua", "au"}


class _Block:
    """What a conversation's consecutive rows come to."""

    def __init__(self, turn: object, initial: str) -> None:
        self.first_turn = self.least_turn = self.last_turn = turn
        self.first = self.last = initial
        self.turns = 1 if turn is not None else 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.symbols: list[str] = []

    def add(self, turn: object, initial: str, fault: str) -> None:
        if self.symbols:
            self.illegal += self.last + initial not in LEGAL
            if turn is not None and turn != self.last_turn:
                self.turns += 1
                self.least_turn = turn if self.least_turn is None else self.least_turn
        self.last, self.last_turn = initial, turn
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        self.symbols.append("-" if fault in ("blank", "duplicate") else initial.upper() if fault else initial)

    def row(self, conv: object, task: int, number: int, begins: bool) -> tuple:
        symbols = "".join(self.symbols)
        # A block that begins a conversation begins in one state only.
        answers = [repair(symbols, b, e) if not begins or b == START else None for b in STATES for e in STATES]
        return (
            conv, task, number, self.first_turn, self.last_turn, self.least_turn, self.turns, self.first, self.last, self.blank, self.duplicate,
            self.truncated, self.illegal, [-1 if a is None else a[0] for a in answers], ["" if a is None else a[1] for a in answers],
        )


def _types(df: DataFrame) -> dict[str, str]:
    return {c: df.schema[c].dataType.simpleString() for c in ("conv", "turn")}


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T._parse_datatype_string(schema))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


# Rows of a result handed over at a time.
BATCH = 1000
ORDER = ["conv", "turn", "role", "digest"]


def blocks(rows: DataFrame) -> DataFrame:
    """Blocks of rows in the order of conversation, turn (NULL first), role and digest, whatever task holds them."""
    schema = BLOCKS.format(**_types(rows))
    arrow = _arrow(schema)
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        out: list[tuple] = []
        conv, block, number, begun = None, None, 0, 0  # `begun` counts the conversations of the task
        for batch in batches:
            for c, turn, initial, copies, blank, again, truncated in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if not begun or c != conv:
                    if block:
                        # The task's first conversation may have begun in another task.
                        out.append(block.row(conv, task, number, begun > 1 and not number))
                    conv, block, number, begun = c, None, 0, begun + 1
                for copy in range(copies):
                    if block and len(block.symbols) == BLOCK:
                        out.append(block.row(conv, task, number, begun > 1 and not number))
                        block, number = None, number + 1
                    block = block or _Block(turn, initial)
                    block.add(turn, initial, "blank" if blank else "duplicate" if again or copy else "truncated" if truncated else "")
                if len(out) >= BATCH:
                    yield _batch(out, arrow)
                    out = []
        if block:
            out.append(block.row(conv, task, number, begun > 1 and not number))
        yield _batch(out, arrow)

    narrow = rows.repartitionByRange(tasks, *ORDER).sortWithinPartitions(*ORDER)
    return arrow_map(narrow.select("conv", "turn", "initial", "copies", "blank", "again", "truncated"), run, schema)


AUDITS = "conv {conv}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def audits(pieces: DataFrame) -> DataFrame:
    """Counts, cost and edits per conversation from its blocks, which a task reads one conversation after the other. It
    holds the answers of one conversation, some sixteen times its edits, which are a value of the result."""
    schema = AUDITS.format(**_types(pieces.withColumnRenamed("last_turn", "turn")))
    arrow = _arrow(schema)
    order = ["conv", "task", "number"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out: list[tuple] = []

        def closed() -> tuple:
            illegal, turns, least, last = 0, 0, None, None
            for k, b in enumerate(held):
                turns += b["turns"]
                illegal += b["illegal"]
                if k:
                    illegal += held[k - 1]["last"] + b["first"] not in LEGAL
                    turns -= b["first_turn"] is not None and b["first_turn"] == held[k - 1]["last_turn"]
                least = b["least_turn"] if least is None else least
                last = b["last_turn"] if b["last_turn"] is not None else last
            gaps = 0 if least is None else last - least + 1 - turns
            answers = [[None if c < 0 else (c, e) for c, e in zip(b["costs"], b["edits"], strict=True)] for b in held]
            cost, edits = stitched(answers)
            return (held[0]["conv"], gaps, *(sum(b[k] for b in held) for k in ("blank", "duplicate", "truncated")), illegal, cost, edits)

        for batch in batches:
            for piece in batch.to_pylist():
                if held and piece["conv"] != held[0]["conv"]:
                    out.append(closed())
                    held = []
                held.append(piece)
            if len(out) >= BATCH:
                yield _batch(out, arrow)
                out = []
        if held:
            out.append(closed())
        yield _batch(out, arrow)

    dealt = pieces.repartition("conv").sortWithinPartitions(*order)
    return arrow_map(dealt, run, schema)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv, repaired_sha256``: the digest of every repaired conversation as ``role:text`` lines.

    A digest takes its text in order, so one task reads a conversation's rows; it holds one row at a time, and the
    conversation's edits, which come before its rows. Rows that must be deleted come without text.
    """
    out = f"conv {_types(rows)['conv']}, repaired_sha256 string"
    arrow, turn = _arrow(out), rows.schema["turn"].dataType
    doomed = F.col("blank") | F.col("again")
    lines = rows.select(
        "conv", F.lit(1).alias("kind"), "turn", F.when(~doomed, F.col("role")).alias("role"), "digest", F.when(~doomed, F.col("text")).alias("text"), "copies",
        F.col("role").alias("order_role"),
    )
    heads = found.select(
        "conv", F.lit(0).alias("kind"), F.lit(None).cast(turn).alias("turn"), F.lit("").alias("role"), F.lit(None).cast("binary").alias("digest"),
        F.col("audit").alias("text"), F.lit(0).cast("bigint").alias("copies"), F.lit("").alias("order_role"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        writer: _Writer | None = None
        for batch in batches:
            for conv, kind, role, text, copies in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if not kind:
                    if writer:
                        done.append((writer.conv, writer.close()))
                    writer = _Writer(conv, text)
                else:
                    writer.rows(role, text, copies)
            if len(done) >= BATCH:
                yield _batch(done, arrow)
                done = []
        if writer:
            done.append((writer.conv, writer.close()))
        yield _batch(done, arrow)

    # One after the other: the shuffle by conversation, then each task's order.
    dealt = lines.unionByName(heads).repartition("conv").sortWithinPartitions("conv", "kind", "turn", "order_role", "digest")
    return arrow_map(dealt.select("conv", "kind", "role", "text", "copies"), run, out)


class _Writer:
    """Applies edits to rows as they come, and digests the result."""

    def __init__(self, conv: object, edits: str) -> None:
        self.conv, self.edits, self.at, self.state = conv, edits, 0, START
        self.digest, self.empty = hashlib.sha256(), True

    def _put(self, role: str, text: str) -> None:
        self.digest.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.empty = False

    def _inserted(self) -> None:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.state = WANTED[self.state]
            self._put(NAMES[self.state], "")
            self.at += 1

    def rows(self, role: str | None, text: str | None, copies: int) -> None:
        for _ in range(copies):
            self._inserted()
            letter = self.edits[self.at]
            self.at += 1
            if letter == "R":
                self.state = WANTED[self.state]
                self._put(NAMES[self.state], text)
            elif letter == "K":
                self.state = KEPT[self.state, role[:1]]
                self._put(role, text)

    def close(self) -> str:
        self._inserted()
        return self.digest.hexdigest()


def repair_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``, a row per conversation of ``df``
    (NULL is a conversation too), of its rows after `damaged`.

    Rows are taken by turn, NULL first; rows of one turn by role, then by a digest of role and text. Copies of a row lie
    side by side, all but one of them duplicates. Conversations without rows after damage have zeros, empty edits and the
    digest of nothing. A role without one of the initials s, u, a is never kept. An empty table gives an empty result.
    Other columns are not looked at. A conversation may hold any share of the rows.
    """
    rows = stored(judged(damaged(df, conv, turn, role, text)), "judged")
    found = stored(audits(stored(blocks(rows), "blocks")), "audits")
    texts = repaired(rows, found)
    everyone = df.select(F.col(conv).alias("conv")).distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
    whole = _joined(_joined(everyone, found), texts)
    return whole.select(
        F.col("conv").alias(conv), *map(zero, ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def _joined(left: DataFrame, right: DataFrame) -> DataFrame:
    """All rows of the left, NULL matching NULL; the right has one row per conversation."""
    other: Column = F.col("r.conv")
    return left.alias("l").join(right.alias("r"), F.col("l.conv").eqNullSafe(other), "left").select("l.*", *[F.col(f"r.{c}") for c in right.columns if c != "conv"])
