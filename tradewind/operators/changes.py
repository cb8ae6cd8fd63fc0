"""Keyed change application: slowly changing dimensions of type 1 and type 2.

Both are pure functions of the set of change rows. Rows of a key are ordered by
the sequence column, then by ingestion time and source file where present, then
by a hash of the row, so equal sequences resolve the same way on every run.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.functions import columns as X
from tradewind.session import scratch

START, END = "__START_AT", "__END_AT"
PROVENANCE = ("_ingestion_timestamp", "_source_file")
ROW, ORDER = "__row", "__order"


def _values(changes: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in changes.columns if c not in keys]


def _order_columns(columns: Sequence[str], sequence_by: str | None) -> dict[str, str]:
    """The fields of an order that repeat a column of the row, with that column; a hash of the row follows them."""
    fields = {} if sequence_by is None else {"s": sequence_by}
    return fields | {f"p{i}": c for i, c in enumerate(PROVENANCE) if c in columns and c != sequence_by}


def with_order(changes: DataFrame, keys: Sequence[str], sequence_by: str | None) -> DataFrame:
    """Adds what decides between two changes of one key, computed once per row."""
    fields = [F.col(c).alias(f) for f, c in _order_columns(changes.columns, sequence_by).items()]
    return changes.withColumn(ORDER, F.struct(
        *fields, F.xxhash64(*_values(changes, keys)).alias("h")))


def thin_order(ordered: DataFrame, sequence_by: str | None) -> DataFrame:
    """The changes with what their own columns do not tell of their order, for a shuffle; see ``full_order``.

    A held change has the values that it won, so a column of its order may be missing among them.
    """
    fields = [F.when(F.col(c).isNull(), F.col(ORDER)[f]).alias(f)
              for f, c in _order_columns(ordered.columns, sequence_by).items()]
    return ordered.withColumn(ORDER, F.struct(*fields, F.col(ORDER)["h"].alias("h")))


def full_order(thin: DataFrame, sequence_by: str | None, hashed: Sequence[str]) -> DataFrame:
    """The order of changes from ``thin_order`` and of plain ones, of which the ``hashed`` columns are all values."""
    given = thin.schema[ORDER].dataType.names if ORDER in thin.columns else []

    def field(name: str, own: Column) -> Column:
        return F.coalesce(F.col(ORDER)[name], own).alias(name) if name in given else own.alias(name)

    fields = [field(f, F.col(c)) for f, c in _order_columns(thin.columns, sequence_by).items()]
    return thin.withColumn(ORDER, F.struct(*fields, field("h", F.xxhash64(*hashed))))


def _known(column: str) -> Column:
    """The column's value with its order, or NULL where there is no value."""
    return F.when(F.col(column).isNotNull(),
                  F.struct(F.col(ORDER).alias("o"), F.col(column).alias("v")))


def _whole(columns: Sequence[str]) -> Column:
    """All columns of the row with their order."""
    return F.struct(F.col(ORDER).alias("o"), F.struct(*[F.col(c) for c in columns]).alias("v"))


# --- type 1 ------------------------------------------------------------------

HELD = "__held"


def scd1_state(changes: DataFrame, keys: Sequence[str], sequence_by: str,
               ignore_null_updates: bool = False) -> DataFrame:
    """One row per key holding, for every column, its winner and when it won.

    States of disjoint or overlapping sets of changes merge with ``merge_states``,
    in any order and any number of times. Winners are maxima, which combine
    before the shuffle, so a key with very many changes stays cheap. With
    ``ignore_null_updates`` a state is a list of changes, the newest first, each
    with its order once and with the values that it won.
    """
    ordered = with_order(changes, keys, sequence_by)
    if ignore_null_updates:
        return merge_changes(ordered, keys)
    return ordered.groupBy(*keys).agg(F.max(_whole(_values(changes, keys))).alias(ROW))


def merge_changes(ordered: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state of changes that carry their order (see ``with_order`` and ``held_changes``).

    A change without NULLs can only win as a whole (a newer value beats it column
    by column); of the others the newest known value of each column is looked for.
    """
    values = [c for c in _values(ordered, keys) if c != ORDER]
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in values], F.lit(True))
    found = ordered.groupBy(*keys).agg(
        F.max(F.when(complete, _whole(values))).alias(ROW), *[F.max(F.when(~complete, _known(c))).alias(c) for c in values])
    newer = found.select(*keys, ROW, *[
        F.when(F.col(ROW).isNull() | (F.col(c)["o"] > F.col(ROW)["o"]), F.col(c)).alias(c) for c in values])
    orders = F.sort_array(F.array_distinct(F.array_compact(F.array(*[F.col(c)["o"] for c in values]))), asc=False)
    won = F.transform(orders, lambda o: F.struct(o.alias("o"), F.struct(*[
        F.when(F.col(c)["o"] == o, F.col(c)["v"]).alias(c) for c in values]).alias("v")))
    return newer.select(*keys, F.concat(won, F.array_compact(F.array(ROW))).alias(HELD))


def held_changes(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The changes in a state; a key of which no value is known keeps a row."""
    held = state.select(*keys, F.explode_outer(HELD).alias(ROW))
    return held.select(*keys, F.col(ROW)["o"].alias(ORDER), f"{ROW}.v.*")


def split_incomplete(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same state, ready to be merged after new columns were added: ``merge_states`` judges each change anew."""
    return state


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    if HELD in states.columns:
        return merge_changes(held_changes(states, keys), keys)
    return states.groupBy(*keys).agg(F.max(ROW).alias(ROW))


def scd1_rows(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The plain table behind a state."""
    if HELD not in state.columns:
        return state.select(*keys, f"{ROW}.v.*")

    def winner(c: str) -> Column:
        known = F.filter(F.transform(HELD, lambda change: change["v"][c]), lambda v: v.isNotNull())
        return F.coalesce(F.get(HELD, F.lit(0))["v"][c], F.get(known, F.lit(0)))  # the first holds most values

    columns = state.schema[HELD].dataType.elementType["v"].dataType.names
    return state.select(*keys, *[winner(c).alias(c) for c in columns])


def scd1(changes: DataFrame, keys: Sequence[str], sequence_by: str,
         ignore_null_updates: bool = False) -> DataFrame:
    """Latest row per key; with ``ignore_null_updates`` the latest known value per column."""
    if not ignore_null_updates and sequence_by not in keys:  # no state is kept: what orders the rows travels once
        first = [sequence_by, *[c for c in PROVENANCE if c in changes.columns and c != sequence_by]]
        values = _values(changes, keys)
        row = F.struct(*first, F.xxhash64(*values).alias(ORDER), *[c for c in values if c not in first])
        return changes.groupBy(*keys).agg(F.max(row).alias(ROW)).select(*keys, f"{ROW}.*").select(*changes.columns)
    return scd1_rows(scd1_state(changes, keys, sequence_by, ignore_null_updates),
                     keys).select(*changes.columns)


# --- type 2 ------------------------------------------------------------------

def one_change_per_sequence(changes: DataFrame, keys: Sequence[str], sequence_by: str,
                            ignore_null_updates: bool = False) -> DataFrame:
    """Collapses changes of one key that carry the same sequence."""
    grain = [*keys, sequence_by]
    values = _values(changes, grain)
    groups = with_order(changes, keys, None).groupBy(*grain)
    if ignore_null_updates:
        return groups.agg(*[F.max(_known(c))["v"].alias(c) for c in values]).select(
            *changes.columns)
    return groups.agg(F.max(_whole(values))["v"].alias(ROW)).select(
        *grain, f"{ROW}.*").select(*changes.columns)


def without_sequence(changes: DataFrame, sequence_by: str) -> DataFrame:
    """The changes that ``scd2`` cannot place, to be looked at or repaired."""
    return changes.filter(F.col(sequence_by).isNull())


def _with_sequence(changes: DataFrame, sequence_by: str) -> DataFrame:
    """The changes; one without a sequence has no place among the versions of its key and stops the job."""
    return changes.withColumn(sequence_by, F.coalesce(F.col(sequence_by), F.raise_error(F.lit(
        f"MissingSequence: a change has no {sequence_by}")).cast(changes.schema[sequence_by].dataType)))


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on the keys with NULL equal to NULL; the key columns are those of the left side."""
    other = {c: f"__r{i}" for i, c in enumerate(keys)}
    renamed = right.withColumnsRenamed(other)
    condition = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[n]) for c, n in other.items()])
    return left.join(renamed, condition, how).drop(*other.values())


def heavy_keys(changes: DataFrame, keys: Sequence[str], max_rows: int) -> DataFrame:
    """Keys with more rows than one task should order; NULL keys count like any other."""
    return (changes.groupBy(*keys).agg(X.rows().alias("n"))
            .filter(F.col("n") > max_rows).select(*keys))


def scd2(changes: DataFrame, keys: Sequence[str], sequence_by: str,
         track_except: Sequence[str] = (), ignore_null_updates: bool = False,
         max_rows_per_key: int = 2_000_000, on_missing_sequence: str = "fail") -> DataFrame:
    """One row per version of a key, valid from __START_AT until before __END_AT.

    A version lasts while the tracked columns keep their values; the columns in
    ``track_except`` show the last value known within the version. The sequence
    may be of any type that can be ordered. A change without a sequence stops
    the job, or is left out with ``on_missing_sequence="skip"`` (see
    ``without_sequence``); NULL keys form a key of their own. All of this is the
    same for keys of every size.

    Keys up to ``max_rows_per_key`` are ordered by one window each. Larger keys
    are cut into stretches of the sequence that are ordered separately and
    connected through one summary row per stretch.
    """
    if on_missing_sequence == "skip":
        changes = changes.filter(F.col(sequence_by).isNotNull())
    else:
        changes = _with_sequence(changes, sequence_by)
    untracked = set(track_except) | {sequence_by}
    tracked = [c for c in _values(changes, keys) if c not in untracked]
    build = _Versions(keys, sequence_by, tracked, _values(changes, keys), ignore_null_updates)

    def singles(rows: DataFrame) -> DataFrame:
        return one_change_per_sequence(rows, keys, sequence_by, ignore_null_updates)

    heavy = heavy_keys(changes, keys, max_rows_per_key)
    if heavy.isEmpty():
        # one shuffle by key serves the collapsing, the windows and the final grouping
        return build.by_key(singles(changes.repartition(*keys)))
    heavy = _stored(heavy)
    light = same_keys(changes, heavy, keys, "left_anti")
    large = singles(same_keys(changes, heavy, keys, "left_semi"))
    versions = build.by_key(singles(light.repartition(*keys)))
    return versions.unionByName(build.by_stretch(_stretches(large, keys, sequence_by, max_rows_per_key)))


def _stored(rows: DataFrame) -> DataFrame:
    """Rows written once to the shared folder, for plans that read them several times."""
    path = scratch(rows.sparkSession, "heavy-keys")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


ROWS_PER_TASK = 250_000  # of a sorted piece: many short stretches share a task


def _stretches(rows: DataFrame, keys: Sequence[str], seq: str, max_rows: int) -> DataFrame:
    """The rows with the number of their stretch, written once so that it cannot change.

    A range shuffle over keys and sequence cuts the rows into pieces of bounded
    size, whatever the type of the sequence and the number of rows per key. Each
    piece is sorted and cut into stretches of half ``max_rows``: their numbers
    ascend with the running number of the row, whose upper bits are the piece's.
    """
    rows = _stored(rows)
    pieces = max(2, math.ceil(rows.count() / ROWS_PER_TASK))
    ranged = rows.repartitionByRange(pieces, *keys, seq).sortWithinPartitions(*keys, seq)
    return _stored(ranged.withColumn("__part", F.floor(F.monotonically_increasing_id() / max(1, max_rows // 2))))


SINCE = "__since"


def extend_scd2(opened: DataFrame, changes: DataFrame, keys: Sequence[str], sequence_by: str,
                track_except: Sequence[str] = (), ignore_null_updates: bool = False) -> DataFrame:
    """The open versions of some keys and all that follows, given later changes of these keys.

    ``opened`` has one open version for each key that has versions already. All
    changes come after the last one their key has seen (see ``late_keys``), so
    the open version stands for everything before it: it holds the last known
    values, and its start is kept. Closed versions stay as they are.
    """
    changes = _with_sequence(changes, sequence_by)
    values = _values(changes, keys)
    tracked = [c for c in values if c not in {*track_except, sequence_by}]
    build = _Versions(keys, sequence_by, tracked, values, ignore_null_updates, SINCE)
    before = opened.withColumnRenamed(START, SINCE).drop(END)
    rows = changes.unionByName(before, allowMissingColumns=True)
    missing = [c for c in rows.columns if c not in (*keys, *values, SINCE)]
    single = one_change_per_sequence(rows.drop(*missing).repartition(*keys), keys, sequence_by, ignore_null_updates)
    return build.by_key(single)


def late_keys(opened: DataFrame, changes: DataFrame, keys: Sequence[str], sequence_by: str,
              max_rows_per_key: int) -> DataFrame:
    """Keys of which a change is not after the last one in their open version, or that have very many."""
    firsts = changes.groupBy(*keys).agg(F.min(sequence_by).alias("__first"), X.rows().alias("__n"))
    lasts = opened.select(*keys, F.col(sequence_by).alias("__last"))
    met = same_keys(firsts, lasts, keys, "left")
    return met.filter((F.col("__first") <= F.col("__last")) | (F.col("__n") > max_rows_per_key)).select(*keys)


class _Versions:
    def __init__(self, keys, seq, tracked, values, fill, since=None):
        self.keys, self.seq, self.tracked, self.values, self.fill = (
            list(keys), seq, tracked, values, fill)
        self.since = F.col(seq) if since is None else F.coalesce(F.col(since), F.col(seq))
        self.filled = [c for c in values if c != seq] if fill else []

    def _state(self) -> Column:
        return F.struct(*[F.col(c) for c in self.tracked])

    def _collapse(self, runs: DataFrame, *run: str) -> DataFrame:
        """Last row of every run of equal tracked values."""
        row = F.max_by(F.struct(*[F.col(c) for c in self.values]), F.col(self.seq))
        return runs.groupBy(*self.keys, *run).agg(F.min(self.since).alias(START), row.alias(ROW))

    def _result(self, versions: DataFrame) -> DataFrame:
        return versions.select(*self.keys, f"{ROW}.*", START, END)

    def by_key(self, rows: DataFrame) -> DataFrame:
        ordered = Window.partitionBy(*self.keys).orderBy(self.seq)
        known = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if self.filled:
            rows = rows.withColumns({c: F.last(c, ignorenulls=True).over(known)
                                     for c in self.filled})
        before = F.lag(self._state()).over(ordered)
        runs = (rows.withColumn("__new", F.coalesce(~before.eqNullSafe(self._state()),
                                                    F.lit(True)).cast("int"))
                .withColumn("__run", F.sum("__new").over(known)))
        following = Window.partitionBy(*self.keys).orderBy(START)
        return self._result(self._collapse(runs, "__run").withColumn(
            END, F.lead(START).over(following)))

    def by_stretch(self, rows: DataFrame) -> DataFrame:
        cut = [*self.keys, "__part"]
        inside = Window.partitionBy(*cut).orderBy(self.seq)
        known = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        earlier = (Window.partitionBy(*self.keys).orderBy("__part")
                   .rowsBetween(Window.unboundedPreceding, -1))
        later = (Window.partitionBy(*self.keys).orderBy(F.desc("__part"))  # a running frame; one that shrinks is quadratic
                 .rowsBetween(Window.unboundedPreceding, -1))

        # what each stretch inherits: last known value of every column, or the last row
        if self.fill:
            leaving = rows.groupBy(*cut).agg(*[
                F.max_by(F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"))),
                         F.when(F.col(c).isNotNull(), F.col(self.seq))).alias(c)
                for c in self.filled])
            entering = leaving.select(*cut, F.struct(*[
                F.last(c, ignorenulls=True).over(earlier)["v"].alias(c)
                for c in self.filled]).alias("__in"),
                F.row_number().over(Window.partitionBy(*self.keys).orderBy("__part"))
                .alias("__nth"))
            rows = same_keys(rows, entering, cut, "inner").withColumns({
                c: F.coalesce(F.last(c, ignorenulls=True).over(known), F.col("__in")[c])
                for c in self.filled})
        else:
            leaving = rows.groupBy(*cut).agg(
                F.max_by(F.struct(*[F.col(c) for c in self.values]), F.col(self.seq))
                .alias("__out"))
            entering = leaving.select(
                *cut, F.last("__out").over(earlier).alias("__in"),
                F.row_number().over(Window.partitionBy(*self.keys).orderBy("__part"))
                .alias("__nth"))
            rows = same_keys(rows, entering, cut, "inner")
        inherited = F.when(F.col("__nth") > 1,
                           F.struct(*[F.col("__in")[c].alias(c) for c in self.tracked]))
        before = F.coalesce(F.lag(self._state()).over(inside), inherited)
        rows = rows.withColumn("__start", F.when(
            F.coalesce(~before.eqNullSafe(self._state()), F.lit(True)), F.col(self.seq)))

        # where the version open at a stretch's border began, and where the next one begins
        borders = rows.groupBy(*cut).agg(F.min("__start").alias("__first"),
                                         F.max("__start").alias("__last"))
        borders = borders.select(
            *cut, F.last("__last", ignorenulls=True).over(earlier).alias("__open"),
            F.last("__first", ignorenulls=True).over(later).alias("__next"))
        runs = same_keys(rows, borders, cut, "inner").withColumn(
            "__run", F.coalesce(F.max("__start").over(known), F.col("__open")))
        ends = (runs.filter(F.col("__start").isNotNull())
                .select(*self.keys, F.col("__start").alias("__run"), F.coalesce(
                    F.lead("__start").over(Window.partitionBy(*cut).orderBy("__start")),
                    F.col("__next")).alias(END)))
        return self._result(same_keys(self._collapse(runs, "__run"), ends, [*self.keys, "__run"], "inner"))


# --- reading a type 2 table --------------------------------------------------

def current(versions: DataFrame) -> DataFrame:
    return versions.filter(F.col(END).isNull())


def as_of_time(versions: DataFrame, moment: Column) -> DataFrame:
    return versions.filter((F.col(START) <= moment)
                           & (F.col(END).isNull() | (F.col(END) > moment)))


# --- whole-table changes -----------------------------------------------------

class DuplicateSourceKey(Exception):
    """Two source rows would change the same target row."""


def check_unique(source: DataFrame, keys: Sequence[str]) -> None:
    """Stops where a key without NULLs has more than one row."""
    complete = source.dropna(subset=list(keys))
    if not complete.groupBy(*keys).agg(X.rows().alias("n")).filter("n > 1").isEmpty():
        raise DuplicateSourceKey(f"more than one source row for a value of {list(keys)}")


def merge(target: DataFrame, source: DataFrame, on: Sequence[str],
          update_cols: Sequence[str] | None = None, insert: bool = True) -> DataFrame:
    """Target with matched rows updated and unmatched source rows added.

    Updates are a left join from the target and inserts an anti join from the
    source: a small source is broadcast and the target is not shuffled at all,
    and a target with a hot key can be split. NULL keys match nothing.
    """
    keys = list(on)
    check_unique(source, keys)
    updated = [c for c in (update_cols if update_cols is not None else source.columns)
               if c not in keys]
    patch = source.select(*keys, F.struct(*[F.col(c) for c in updated]).alias("__new"))
    result = target.join(patch, keys, "left").select(*[
        F.when(F.col("__new").isNotNull(), F.col("__new")[c]).otherwise(F.col(c)).alias(c)
        if c in updated else F.col(c) for c in target.columns])
    if not insert:
        return result
    matched = target.select(*keys).join(source.select(*keys), keys, "left_semi").distinct()
    added = source.join(matched, keys, "left_anti")
    return result.unionByName(added, allowMissingColumns=True).select(*target.columns)


def incremental(target: DataFrame | None, source: DataFrame, key: Sequence[str], cursor: str,
                full_refresh: bool = False, lookback: str | None = None) -> DataFrame:
    """Merges the source rows that are newer than everything in the target.

    Rows at or before the newest loaded instant are not looked at again, so late
    corrections are missed unless ``lookback`` names an interval to re-read.
    A target without any known instant takes every row, also those without a
    cursor; later runs never take rows without one.
    """
    if target is None or full_refresh:
        return source
    newest = target.agg(F.max(cursor)).scalar()
    since = newest if lookback is None else newest - F.expr(f"interval {lookback}")
    return merge(target, source.filter(F.coalesce(F.col(cursor) > since, newest.isNull())), key)


VALID_FROM, VALID_TO = "valid_from", "valid_to"


def opened_rows(source: DataFrame, run_ts: Column) -> DataFrame:
    """Source rows as versions that begin with this run."""
    return source.withColumns({VALID_FROM: run_ts, VALID_TO: F.lit(None).cast(_type_of(source, run_ts))})


def _same(a: Column, b: Column, columns: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in columns], F.lit(True))


def snapshot_news(current: DataFrame, opened: DataFrame, key: Sequence[str], check_cols: Sequence[str]) -> DataFrame:
    """The opened rows whose key is not in the open versions, or with other checked columns there."""
    seen = F.struct(*[F.col(c) for c in check_cols])
    was = current.select(*key, seen.alias("__was"))
    met = same_keys(opened.withColumn("__now", seen), was, key, "left")
    return met.filter(F.col("__was").isNull() | ~_same(F.col("__now"), F.col("__was"), check_cols)).drop("__now", "__was")


def snapshot_check(history: DataFrame | None, source: DataFrame, key: Sequence[str],
                   check_cols: Sequence[str], run_ts: Column) -> DataFrame:
    """Adds a version for every row whose checked columns changed, closing the old one.

    Keys that vanish from the source stay open. ``growing.grow_snapshot`` does
    the same to a stored history without rewriting it.
    """
    keys = list(key)
    check_unique(source, keys)
    opened = opened_rows(source, run_ts)
    if history is None:
        return opened
    fresh = snapshot_news(history.filter(F.col(VALID_TO).isNull()), opened, keys, check_cols)
    replaced = fresh.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)]).withColumn("__ends", F.lit(True))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__k{i}")) for i, c in enumerate(keys)])
    closed = history.join(replaced, same & F.col(VALID_TO).isNull(), "left").withColumn(
        VALID_TO, F.when(F.col("__ends"), run_ts).otherwise(F.col(VALID_TO))).select(*history.columns)
    return closed.unionByName(fresh.select(*history.columns))


def _type_of(df: DataFrame, column: Column):
    return df.select(column.alias("c")).schema["c"].dataType
