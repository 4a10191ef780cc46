"""Change events folded into current state (type 1) or into validity intervals (type 2).

Both are functions of the *set* of events: the order (sequence, tie-break, row hash) is total, so arrival order, batch
borders and replays do not show in the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.keys import event_order, order_columns
from strata.operators.skew import KEY, ROWS_PER_SLICE, SLICE, heavy_keys, in_ranges, other_rows, rows_of

START_AT, END_AT = "__START_AT", "__END_AT"
_DELETED = "__deleted"


def split_unsequenced(changes: DataFrame, sequence_by: str | Column) -> tuple[DataFrame, DataFrame]:
    """(events that can be ordered, events with a NULL sequence together with the reason)."""
    sequence = F.col(sequence_by) if isinstance(sequence_by, str) else sequence_by
    return (
        changes.where(sequence.isNotNull()),
        changes.where(sequence.isNull()).withColumn("quarantine_reason", F.lit("sequence is NULL")),
    )


def latest_per_key(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Column,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The last event of every key, deletes included.

    ``row_number() = 1`` lets Spark keep one row per key and task before the shuffle, so a key that holds a large share
    of all events sends no more rows than any other.
    """
    return _last(changes, keys, event_order(changes, sequence_by, tie_break))


def _last(events: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    last = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order])
    return (
        events.where(order[0].isNotNull())
        .withColumn("__rank", F.row_number().over(last))
        .where("__rank = 1")
        .drop("__rank")
    )


def scd1(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Column,
    tie_break: Sequence[str] | None = None,
    apply_as_deletes: str | Column | None = None,
    except_columns: Sequence[str] = (),
    dealt_by: Sequence[str] | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """One current row per key; a key whose last event is a delete is absent.

    With ``dealt_by``, some of the keys, rows are shuffled by these alone, and a join or grouping by them needs no other
    shuffle. Where they have values with more than ``rows_per_slice`` rows, those rows go by all keys.
    """
    fold = lambda rows: latest_per_key(rows, keys, sequence_by, tie_break)
    heavy = heavy_keys(changes, dealt_by, None, rows_per_slice) if dealt_by else None
    if not dealt_by:
        latest = fold(changes)
    elif heavy is None:
        latest = fold(changes.repartition(*dealt_by))
    else:
        usual = fold(other_rows(changes, heavy, dealt_by).repartition(*dealt_by))
        latest = usual.unionByName(fold(rows_of(changes, heavy, dealt_by).drop(KEY)))
    return publish_scd1(latest, apply_as_deletes, except_columns)


def publish_scd1(
    latest: DataFrame,
    apply_as_deletes: str | Column | None = None,
    except_columns: Sequence[str] = (),
) -> DataFrame:
    """What readers see of :func:`latest_per_key`."""
    return latest.where(~_predicate(apply_as_deletes)).drop(*except_columns)


def distinct_events(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Column,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The last event of every (key, sequence): all that history depends on.

    Like :func:`latest_per_key` this drops rows before the shuffle, and it shuffles by key *and* sequence, so neither a
    heavy key nor a heavy instant ends up in one task.
    """
    order = event_order(changes, sequence_by, tie_break)
    return _last(changes, [*keys, order[0]], order)


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Column,
    tie_break: Sequence[str] | None = None,
    apply_as_deletes: str | Column | None = None,
    except_columns: Sequence[str] = (),
    track_columns: Sequence[str] | None = None,
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """One row per version, valid from ``__START_AT`` until before ``__END_AT`` (NULL while current).

    Of several events of one key with equal sequence only the last in the total order is a version. A delete ends the
    open version and is not one itself. With ``track_columns``, events that change none of these columns extend the
    version before them.

    ``rows_per_slice`` bounds the rows of one key in one task; None skips the search for keys beyond it.
    """
    versions = timeline(
        changes, keys, sequence_by, tie_break, apply_as_deletes, track_columns, rows_per_slice
    )
    return publish_scd2(versions, sequence_by, apply_as_deletes, except_columns)


def timeline(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Column,
    tie_break: Sequence[str] | None = None,
    apply_as_deletes: str | Column | None = None,
    track_columns: Sequence[str] | None = None,
    rows_per_slice: int | None = ROWS_PER_SLICE,
) -> DataFrame:
    """The source columns and ``__END_AT`` for every version and every delete."""
    names, computed = order_columns(changes, sequence_by, tie_break)
    events = changes.withColumns({**computed, _DELETED: _predicate(apply_as_deletes)}).where(
        F.col(names[0]).isNotNull()
    )
    heavy = heavy_keys(events, keys, names[0], rows_per_slice) if rows_per_slice else None
    if heavy is None:
        versions = _versions(events, keys, names, track_columns)
    else:
        usual = _versions(other_rows(events, heavy, keys), keys, names, track_columns)
        slices = -(-heavy.agg(F.sum("__n")).first()[0] // rows_per_slice)
        cut = _sliced_versions(rows_of(events, heavy, keys), slices, rows_per_slice, names, track_columns)
        versions = usual.unionByName(cut)
    return versions.select(*changes.columns, END_AT)


def publish_scd2(
    versions: DataFrame,
    sequence_by: str | Column,
    apply_as_deletes: str | Column | None = None,
    except_columns: Sequence[str] = (),
) -> DataFrame:
    """What readers see of :func:`timeline`."""
    sequence = F.col(sequence_by) if isinstance(sequence_by, str) else sequence_by
    kept = [c for c in versions.columns if c not in {*except_columns, END_AT}]
    return versions.where(~_predicate(apply_as_deletes)).select(
        *kept, sequence.alias(START_AT), END_AT
    )


def current_versions(history: DataFrame) -> DataFrame:
    """The versions that are still open."""
    return history.where(F.col(END_AT).isNull())


def _versions(
    events: DataFrame, keys: Sequence[str], order: Sequence[str], track: Sequence[str] | None
) -> DataFrame:
    """All windows share one partitioning and one order, hence one shuffle and one sort."""
    sequence = order[0]
    timeline = Window.partitionBy(*keys).orderBy(*order)
    following = F.lead(sequence).over(timeline)
    versions = events.withColumn(END_AT, following).where(
        F.col(END_AT).isNull() | (F.col(END_AT) != F.col(sequence))
    )
    if track is not None:
        state = F.struct(*track, _DELETED)
        versions = (
            versions.withColumn("__same", F.lag(state).over(timeline).eqNullSafe(state))
            .where("NOT __same")
            .drop("__same")
            .withColumn(END_AT, following)
        )
    return versions


def _sliced_versions(
    events: DataFrame, slices: int, rows_per_slice: int, order: Sequence[str], track: Sequence[str] | None
) -> DataFrame:
    """:func:`_versions` of heavy keys, by range of (key, sequence) instead of key.

    Ties go first, in a window by (key, sequence) that drops rows before its shuffle, so that not even one heavy instant
    reaches a single task. What a slice must know of its neighbours (the first sequence after it, the tracked values
    before it) is one row per key and non-empty slice, aggregated before it is shuffled.
    """
    sequence = order[0]
    last = _last(events, [KEY, sequence], [F.col(c) for c in order])
    rows = sliced = in_ranges(last, [KEY, sequence], slices, rows_per_slice)
    timeline = Window.partitionBy(KEY, SLICE).orderBy(sequence)
    between = Window.partitionBy(KEY).orderBy(SLICE)

    if track is not None:
        state = F.struct(*track, _DELETED)
        before = (
            rows.groupBy(KEY, SLICE)
            .agg(F.max_by(state, F.struct(*order)).alias("__last"))
            .select(KEY, SLICE, F.lag("__last").over(between).alias("__before"))
        )
        sliced = (
            sliced.join(before, [KEY, SLICE], "left")
            .withColumn(
                "__same",
                F.coalesce(F.lag(state).over(timeline), F.col("__before")).eqNullSafe(state),
            )
            .where("NOT __same")
            .drop("__same", "__before")
        )
        starts = sliced
    else:
        starts = rows

    after = (
        starts.groupBy(KEY, SLICE)
        .agg(F.min(sequence).alias("__first"))
        .select(KEY, SLICE, F.lead("__first").over(between).alias("__after"))
    )
    return (
        sliced.join(after, [KEY, SLICE], "left")
        .withColumn(END_AT, F.coalesce(F.lead(sequence).over(timeline), F.col("__after")))
        .drop("__after", KEY, SLICE)
    )


def _predicate(p: str | Column | None) -> Column:
    if p is None:
        return F.lit(False)
    return F.coalesce(F.expr(p) if isinstance(p, str) else p, F.lit(False))
