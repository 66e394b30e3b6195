"""Merges that turn a table and a batch of changes into the next state of the table.

Plan shape shared by the three merges: the table is left-joined to the batch, and batch rows whose
key the table lacks are added by an anti join. Two joins instead of one full outer join, because
Spark can broadcast the batch when it is small (then the table is not shuffled at all) and AQE
can split a hot key of the table; neither works for a full outer join.

A key may match a table row only once. Whether keys repeat is found out first, by a count over the
keys of the batch alone; only if some do are they looked up in the table, where they fail the
merge, and left out of the join. So merging starts a job, and rows of the batch are shuffled as
they are. The batch is read more than once: stage it (``sources.tables.stage``).

``bucketed=True`` is for a table bucketed by the keys (``bucketBy``) that holds no NULL key.
Keys are then compared with plain equality, and the table is joined bucket by bucket without
being shuffled; in return a hot key of the table stays in its bucket, unsplit.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.functions.predicates import changed, keys_equal, moment, no_null
from tierflow.operators.dedupe import Order, dedupe_latest
from tierflow.session import scratch_path, shuffles_freed
from tierflow.sources.tables import stage


def _repeated(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of several rows."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys)


def fail_if_any(message: str, found: DataFrame) -> None:
    """Fail if there is any row."""
    with shuffles_freed(found.sparkSession):
        found.select(F.raise_error(F.lit(message))).limit(1).collect()


def _none(found: DataFrame) -> bool:
    with shuffles_freed(found.sparkSession):
        return found.isEmpty()


def several_match(keys: Sequence[str]) -> str:
    return f"several source rows match one target row on {', '.join(keys)}"


def _packed(batch: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The keys and, as ``_row``, which is never NULL, the other columns.

    Both joins of a merge take the batch in this form, so that they share one exchange of it.
    """
    return batch.select(*keys, (F.struct(*cols) if cols else F.lit(True)).alias("_row"))


def _matching(batch: DataFrame, target: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """The batch for a join to the table; fails if the table holds a key of several rows."""
    repeated = _repeated(batch, keys)
    if not _none(repeated):
        equal = keys_equal("t", "s", keys, null_safe)
        fail_if_any(several_match(keys),
              target.select(*keys).alias("t").join(repeated.alias("s"), equal, "left_semi"))
        # written, so that the join to the table has an exchange of its own and AQE can split it
        batch = stage(batch.alias("t").join(repeated.alias("s"), equal, "left_anti"), scratch_path(batch.sparkSession, "single"))
    return batch


def unmatched(batch: DataFrame, table_keys: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Batch rows whose key the table does not hold.

    The table's keys are first cut down to those the batch has and made distinct, so that a small
    batch shuffles nothing large, and a hot key is one row. The others are told by a left join: an anti
    join would be moved below the packing of the batch, and not share its exchange.
    """
    return without_held(batch, held_keys(table_keys, batch, keys, null_safe), keys, null_safe)


def held_keys(table_keys: DataFrame, batch: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """The distinct keys of the batch that the table holds."""
    return table_keys.select(*keys).alias("t").join(
        batch.select(*keys).alias("s"), keys_equal("t", "s", keys, null_safe), "left_semi").distinct()


def without_held(batch: DataFrame, held: DataFrame, keys: Sequence[str], null_safe: bool, which: str = "true") -> DataFrame:
    """Batch rows, of those which ``which`` tells, whose key is not among the distinct ``held`` ones.

    One condition on both sides, as Spark would move one on the batch alone below its exchange.
    """
    marked = held.withColumn("_held", F.lit(True))
    joined = batch.alias("s").join(marked.alias("t"), keys_equal("s", "t", keys, null_safe), "left")
    return joined.where(F.coalesce(~F.col("t._held"), F.expr(which))).select("s.*")


def _like(df: DataFrame, table: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """The table's columns in its order and types, NULL where ``df`` has no such column."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in table.schema.fields if cols is None or f.name in cols
    ])


def _replaced(target: DataFrame, batch: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame | None:
    """Table rows without a batch row of their key, and all of the batch; None if that is no merge.

    It is one if no key that both have is one of several rows of either. Only the batch's keys are
    shuffled, its rows stay where they are read. Of floating keys the table's own form is kept, which
    the batch's rows may not have. A small batch leaves the table unshuffled in the other way, not here.
    """
    if not _all_exact(target.select(*keys)) or batch.limit(SMALL_BATCH + 1).count() <= SMALL_BATCH:
        return None
    equal = keys_equal("t", "s", keys, null_safe)
    for rows, others in ((batch, target), (target, batch)):
        repeated = _repeated(rows, keys)
        if not _none(repeated) and not _none(repeated.alias("t").join(others.select(*keys).alias("s"), equal, "left_semi")):
            return None
    return target.alias("t").join(batch.select(*keys).alias("s"), equal, "left_anti").unionByName(batch)


def _all_exact(rows: DataFrame) -> bool:
    return all(f.dataType.typeName() in EXACT for f in rows.schema.fields)


# Up to so many rows a batch is not taken as it is: Spark may broadcast it, and count no keys of the table.
SMALL_BATCH = 100_000
# Types of which equal values are the same.
EXACT = ("string", "byte", "short", "integer", "long", "decimal", "date", "timestamp", "timestamp_ntz", "boolean")


def scd1_merge(target: DataFrame, source: DataFrame, keys: Sequence[str],
               update_cols: Sequence[str] | None = None, on_duplicate: str = "error",
               latest_by: Sequence[Order] = (), bucketed: bool = False, replace: bool = False) -> DataFrame:
    """Overwrite matched rows, add the others; NULL keys match NULL.

    A target row matched by several source rows fails the job, unless ``on_duplicate`` is
    ``"latest"``: then the first row per key in ``latest_by`` order stands for its key. Source
    rows without a match are all added, several of one key too.

    ``replace`` takes the batch as it is in place of matched rows, if all columns are updated and no
    matched key repeats, which is looked up first. The result is the same, and the batch's values are not
    shuffled. It takes no effect for small batches. With ``"latest"`` the chosen rows are written to a scratch table.
    """
    if on_duplicate == "latest":
        source = stage(dedupe_latest(source, keys, latest_by), scratch_path(target.sparkSession, "latest"))
    elif on_duplicate != "error":
        raise ValueError(f"on_duplicate must be error or latest, not {on_duplicate!r}")
    update_cols = list(update_cols or [c for c in target.columns if c not in keys])
    others = [c for c in target.columns if c not in keys]
    source = _like(source, target)
    if replace and set(update_cols) >= set(others):
        replaced = _replaced(target, source, keys, not bucketed)
        if replaced is not None:
            return replaced
    source = _packed(source, keys, others)

    joined = target.alias("t").join(
        _matching(source, target, keys, not bucketed).alias("s"), keys_equal("t", "s", keys, not bucketed), "left")
    hit = F.col("s._row").isNotNull()
    updated = joined.select(*[
        F.when(hit, F.col(f"s.{c}" if c in keys else f"s._row.{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in update_cols else F.col(f"t.{c}")
        for c in target.columns
    ])
    first = unmatched(source, target, keys, not bucketed)
    return updated.unionByName(first.select(*keys, *[f"_row.{c}" for c in others]))


# What becomes of a current row: it stays, it is closed, or a new version of it starts.
STAY, CLOSE, START = 0, 1, 2


def scd2_delta(current: DataFrame, known_keys: DataFrame, source: DataFrame, keys: Sequence[str],
               tracked_cols: Sequence[str], run_ts: datetime | str | Column, null_safe: bool = True,
               version_cols: Sequence[str] | None = None, bucketed: bool = False,
               unknown: DataFrame | None = None) -> DataFrame:
    """The rows that replace ``current``: open ones and, with flag 'N', those closed by this run.

    ``current`` are the rows without an end date; ``known_keys`` the keys of the closed rows. Only
    batch rows without a current row are looked up there. A current row is closed if a tracked column differs from the source row of
    its key, and a new version starts if a column of ``version_cols`` (default: the same)
    differs. Keys never seen start a first version. NULL keys match nothing.

    ``unknown`` are the distinct source keys without a current row, if they and that no other key is one of
    several source rows were found out before; then neither is looked up again.
    """
    business = [c for c in current.columns if c not in ("start_date", "end_date", "active_flag")]
    source = _like(source, current, business)
    now = moment(run_ts)

    values = [c for c in business if c not in keys]
    source = _packed(source, keys, values)
    # Without NULL keys in the batch both joins take it as it is, and share its exchange.
    able = source if source.where(~no_null(keys)).isEmpty() else source.where(no_null(keys))
    matching = able if unknown is not None else _matching(able, current.where(no_null(keys)), keys, not bucketed)
    joined = current.alias("t").join(matching.alias("s"), keys_equal("t", "s", keys, not bucketed), "left").select("t.*", "s._row")
    hit = F.col("_row").isNotNull()
    closes = hit & changed("t", "_row", tracked_cols, null_safe)
    starts = hit & changed("t", "_row", list(version_cols or tracked_cols), null_safe)
    fates = (
        F.when(closes & starts, F.array(F.lit(CLOSE), F.lit(START)))
        .when(closes, F.array(F.lit(CLOSE)))
        .when(starts, F.array(F.lit(STAY), F.lit(START)))
        .otherwise(F.array(F.lit(STAY)))
    )
    after = joined.alias("t").withColumn("_fate", F.explode(fates))
    fate = F.col("_fate")
    after = after.select(
        *[F.when(fate == START, F.col(f"_row.{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
          for c in business],
        F.when(fate == START, now).otherwise(F.col("start_date")).alias("start_date"),
        F.when(fate == CLOSE, now).otherwise(F.lit(None)).alias("end_date"),
        F.when(fate == CLOSE, F.lit("N")).when(fate == START, F.lit("Y"))
        .otherwise(F.col("active_flag")).alias("active_flag"),
    )
    # Without the tables' NULL keys, NULL source keys count as unmatched. Closed rows are searched for
    # the keys without an open one.
    if unknown is None:
        held = held_keys(current.where(no_null(keys)), source, keys, not bucketed)
        missing = without_held(source.select(*keys), held, keys, not bucketed)
        held = held.unionByName(held_keys(known_keys.where(no_null(keys)), missing, keys, not bucketed))
        first = without_held(source, held, keys, not bucketed)
    else:
        equal = keys_equal("t", "s", keys, not bucketed)
        never = unknown.select(*keys).alias("t").join(known_keys.select(*keys).alias("s"), equal, "left_anti").withColumn("_never", F.lit(True))
        first = source.alias("s").join(never.alias("t"), equal, "left").where(F.coalesce(F.col("_never"), ~no_null([f"s.{c}" for c in keys]))).select("s.*")
    first = first.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in values]).select(
        *business, now.alias("start_date"),
        F.lit(None).cast("timestamp_ntz").alias("end_date"), F.lit("Y").alias("active_flag"))
    return after.unionByName(first)


def scd2_parts(target: DataFrame, source: DataFrame, keys: Sequence[str], tracked_cols: Sequence[str],
               run_ts: datetime | str | Column, null_safe: bool = True,
               version_cols: Sequence[str] | None = None, bucketed: bool = False) -> tuple[DataFrame, DataFrame]:
    """``scd2_merge`` without the rows closed earlier, as (open rows, rows closed now)."""
    delta = scd2_delta(target.where("end_date IS NULL"), target.where("end_date IS NOT NULL"), source, keys, tracked_cols, run_ts,
                       null_safe, version_cols, bucketed)
    return delta.where("end_date IS NULL"), delta.where("end_date IS NOT NULL")


def scd2_merge(target: DataFrame, source: DataFrame, keys: Sequence[str], tracked_cols: Sequence[str],
               run_ts: datetime | str | Column, null_safe: bool = True,
               version_cols: Sequence[str] | None = None, bucketed: bool = False) -> DataFrame:
    """Close changed current rows and start new versions; see ``scd2_delta``.

    Rows closed earlier pass through untouched and unshuffled. A key whose versions are all
    closed is not started again, and a key missing from the source is not closed. A current
    row matched by several source rows fails the job.
    """
    delta = scd2_delta(target.where("end_date IS NULL"), target.where("end_date IS NOT NULL"), source, keys, tracked_cols, run_ts,
                       null_safe, version_cols, bucketed)
    return target.where("end_date IS NOT NULL").unionByName(_like(delta, target))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str],
                  cols: Sequence[str] | None = None) -> DataFrame:
    """The change rows that lead from one snapshot to the next.

    Adds ``_action`` and ``_is_update``: a new key gives INSERT/false, a lost key DELETE/false,
    a changed one the pair DELETE/true (old values) and INSERT/true (new values). Keys are
    compared null-safe and have to be unique in each snapshot, else the job fails.

    Each snapshot is shuffled once: sorted by key, the old row of a key stands next to the new one, and
    so does a second row of the same snapshot, which fails the job when it is met.
    """
    cols = list(cols or [c for c in new.columns if c not in keys])
    old, new = (rows.select(*keys, *cols, F.lit(is_new).alias("_new")) for rows, is_new in ((old, False), (new, True)))
    by_key = Window.partitionBy(*keys).orderBy("_new")
    # Shuffled before the values are packed for the window: flat rows are smaller.
    packed = old.unionByName(new).repartition(*keys).select(*keys, "_new", F.struct(*cols).alias("_row"))
    sides = packed.withColumns({
        "_before": F.lag(F.struct("_new", "_row")).over(by_key), "_after": F.lead(F.struct("_new", "_row")).over(by_key)})
    other = F.when(F.col("_new"), F.col("_before")).otherwise(F.col("_after"))
    repeated = F.raise_error(F.lit(f"a snapshot holds several rows of one key on {', '.join(keys)}")).cast("boolean")
    paired = other.isNotNull()
    beside = [F.col(name)["_new"].eqNullSafe(F.col("_new")) for name in ("_before", "_after")]
    changes = F.when(beside[0] | beside[1], repeated).otherwise(~paired | ~other["_row"].eqNullSafe(F.col("_row")))
    return (
        sides.where(changes)
        .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in cols],
                F.when(F.col("_new"), "INSERT").otherwise("DELETE").alias("_action"), paired.alias("_is_update"))
    )


def drop_update_deletes(changes: DataFrame) -> DataFrame:
    """Leave out the DELETE half of update pairs; its INSERT half carries the new values."""
    return changes.where("NOT (_action = 'DELETE' AND _is_update)")


def cdc_apply(target: DataFrame, changes: DataFrame, keys: Sequence[str],
              compare_cols: Sequence[str] | None = None, compat: bool = False,
              upsert_on_insert: bool = False, bucketed: bool = False, replace: bool = False,
              once: bool = False) -> DataFrame:
    """Apply change rows (``_action``, ``_is_update``) to a table; NULL keys match NULL.

    ===========  =======  =========  =================================================
    in target    action   is_update  effect
    ===========  =======  =========  =================================================
    yes          DELETE   false      row deleted (``compat``: only if is_update is true)
    yes          INSERT   true       all columns set, if a column of ``compare_cols`` differs
    yes          INSERT   false      none, or as above with ``upsert_on_insert``
    no           INSERT   false      row added
    ===========  =======  =========  =================================================

    Nothing else has an effect. A key with a true delete and an insert is one that was deleted and
    added again: its old rows go, its inserts are added (``upsert_on_insert``: it is updated). In
    ``compat`` inserts are matched against the table before the deletes. A target row for which
    several delete or update rows exist fails the job.

    ``replace`` is that of ``scd1_merge``, for a feed of inserts alone with ``upsert_on_insert``, if all
    columns are compared; whether it is one is looked up first. ``once`` says that no key has several
    changes, which is then not looked up.
    """
    cols = target.columns
    compare_cols = list(compare_cols or [c for c in cols if c not in keys])
    flags = changes.withColumn("_is_update", F.coalesce("_is_update", F.lit(False)))
    values = [F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    changes = flags.select(*values, "_action", "_is_update")

    is_insert = F.col("_action") == "INSERT"
    if replace and upsert_on_insert and set(compare_cols) | set(keys) >= set(cols) and _all_exact(target):
        if changes.where(~F.coalesce(is_insert & ~F.col("_is_update"), F.lit(False))).isEmpty():
            replaced = _replaced(target, changes.select(*cols), keys, not bucketed)
            if replaced is not None:
                return replaced
    deletes = (F.col("_action") == "DELETE") & (F.col("_is_update") == F.lit(compat))
    updates = is_insert & (F.lit(True) if upsert_on_insert else F.col("_is_update"))

    others = [c for c in cols if c not in keys]
    inserts = changes.where(is_insert & ~F.col("_is_update"))
    deleted = changes.where(deletes)
    effective = changes.where(deletes | updates)
    if not compat and upsert_on_insert:
        renewed = inserts.select(*keys).distinct()
        effective = changes.where(updates).unionByName(
            deleted.alias("t").join(renewed.alias("s"), keys_equal("t", "s", keys), "left_anti"))
    # Deletes are shuffled without values.
    effective = effective.withColumns({c: F.when(F.col("_action") != "DELETE", F.col(c)) for c in others})
    effective, inserts = (_packed(rows, keys, [*others, "_action", "_is_update"]) for rows in (effective, inserts))
    matching = effective if once else _matching(effective, target, keys, not bucketed)
    joined = (
        target.alias("t")
        .join(matching.alias("s"), keys_equal("t", "s", keys, not bucketed), "left")
        .where("s._row IS NULL OR s._row._action <> 'DELETE'").select("t.*", "s._row")
    )
    overwrite = F.col("_row").isNotNull() & changed("t", "_row", [c for c in compare_cols if c not in keys])
    kept = joined.alias("t").select(*[
        F.when(overwrite, F.col(f"_row.{c}")).otherwise(F.col(c)).alias(c) if c in others else F.col(c) for c in cols])
    held = held_keys(target, inserts, keys, not bucketed)
    if upsert_on_insert:
        # All inserts are among the effective rows, whose exchange the join has.
        added = without_held(effective, held, keys, not bucketed, "_row._action = 'INSERT' AND NOT _row._is_update")
    elif compat:
        added = without_held(inserts, held, keys, not bucketed)
    else:
        gone = deleted.select(*keys).distinct()
        stays = held.alias("t").join(gone.alias("s"), keys_equal("t", "s", keys), "left_anti")
        added = without_held(inserts, stays, keys, not bucketed)
    return kept.unionByName(added.select(*[F.col(c if c in keys else f"_row.{c}").alias(c) for c in cols]))


def row_changes(old: DataFrame, new: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """New rows whose key exists in the old table with another value in ``cols`` (null-safe).

    Keys have to be unique in both tables, else the job fails.
    """
    for rows in (old, new):
        fail_if_any(f"a table holds several rows of one key on {', '.join(keys)}", _repeated(rows, keys))
    return (
        new.alias("n").join(old.select(*keys, *cols).alias("o"), keys_equal("n", "o", keys))
        .where(changed("n", "o", cols)).select("n.*")
    )
