"""Deduplication, merge and incremental load (M1-M6).

All merges are pure: they take the current target and a batch and return the new
target as a lazy DataFrame. Writing it back (atomically enough to survive a failed run)
is the job of :func:`martworks.sinks.writers.replace_table`.

Key rules shared by every operator here, as a relational UNIQUE key behaves:
* keys compare with plain equality, so a row with a NULL in any key column never
  conflicts with another row, in the batch or in the target;
* "first"/"last" need an explicit arrival order (``order_by``): Spark has no row order.

Scale notes: deduplication is ``row_number() = 1``, which Spark plans with a group limit
before the shuffle: each task keeps one row of a hot key, so no task sorts all rows of it.
Rows with NULL keys get a per-row group id instead of sharing one (they would all hash to
one partition). Join sides built from a batch are its distinct keys; the in-place writers
stage them and broadcast them when their real size is small, so a small batch does not
shuffle the target. The pure operators leave that choice to AQE.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martworks.functions.columns import as_col
from martworks.operators.transform import (
    SchemaError,
    as_timestamp,
    literal_for,
    normalize_columns,
)

_LONER = "_loner"
_RANK = "_rank"


def any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _pick_one(df: DataFrame, keys: Sequence[str], order_by: Sequence, last: bool) -> DataFrame:
    if not order_by:
        raise ValueError("order_by is required: it defines which row is first or last")
    cols = df.columns
    # a row with a NULL key is its own group: the extra grouping column is NULL for
    # keyed rows and a per-row id otherwise, so NULL-key rows neither merge nor pile
    # up in one partition, and the input is scanned once
    loner = F.when(any_null(keys), F.monotonically_increasing_id())
    order = [as_col(o).desc_nulls_last() if last else as_col(o).asc_nulls_first() for o in order_by]
    w = Window.partitionBy(*keys, _LONER).orderBy(*order)
    ranked = df.withColumn(_LONER, loner).withColumn(_RANK, F.row_number().over(w))
    return ranked.where(F.col(_RANK) == 1).select(*cols)


def one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence | None) -> DataFrame:
    """One row per key: the first by ``order_by``, else a fixed one of them (by hash)."""
    return dedupe_first(df, keys, order_by or [F.xxhash64(*df.columns)])


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """M1: one row per key, the first by ``order_by`` (ascending, NULLs first).

    ``order_by`` must be unique within a key; rows with a NULL key are all kept.
    """
    return _pick_one(df, keys, order_by, last=False)


def dedupe_last(df: DataFrame, keys: Sequence[str], order_by: Sequence) -> DataFrame:
    """One row per key, the last by ``order_by``; rows with a NULL key are all kept."""
    return _pick_one(df, keys, order_by, last=True)


def _stamp(df: DataFrame, stamp: tuple[str, object] | None) -> DataFrame:
    if stamp is None:
        return df
    name, value = stamp
    return df.withColumn(name, as_timestamp(value))


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence,
    update_cols: Sequence[str] | None = None,
    stamp: tuple[str, object] | None = None,
    known_keys: DataFrame | None = None,
) -> DataFrame:
    """M2: ``INSERT ... ON CONFLICT (keys) DO UPDATE SET update_cols``.

    New keys are inserted; on an existing key ``update_cols`` (default: every non-key
    column) take the batch's values, the others keep the target's. Within the batch the
    rows of a key apply in ``order_by`` order: the update columns end with the last row's
    values, the other columns of a new key with the first row's (it was inserted, later
    rows only updated it). ``stamp=(column, as_of)`` sets that column on every inserted or
    updated row (``loaded_at = CURRENT_TIMESTAMP``). ``known_keys``: the batch's distinct
    non-NULL keys, if the caller has them (staged, or marked for broadcast).
    """
    touched = batch_keys(batch, keys) if known_keys is None else known_keys
    cols = target.columns
    stamp_col = stamp[0] if stamp else None
    update = [c for c in (update_cols if update_cols is not None else cols) if c not in keys]
    keep = [c for c in cols if c not in keys and c not in update and c != stamp_col]
    batch_cols = [c for c in cols if c in batch.columns and c not in keys]
    # Row at a time, the first batch row of a new key is inserted and later rows only
    # update ``update``: so the update columns come from the last row, the others from
    # the first. One aggregation picks both; without the others the last row is enough.
    last_cols = [c for c in batch_cols if c in update or c == stamp_col]
    first_cols = [c for c in batch_cols if c in keep]
    order = F.struct(*[as_col(o) for o in order_by])
    if first_cols:
        picks = [F.min_by(F.struct(*first_cols), order).alias("_first")]
        if last_cols:
            picks.append(F.max_by(F.struct(*last_cols), order).alias("_last"))
        loner = F.when(any_null(keys), F.monotonically_increasing_id()).alias(_LONER)
        grouped = batch.groupBy(*keys, loner).agg(*picks)
    else:
        grouped = dedupe_last(batch, keys, order_by)
    b = grouped.select(
        *[
            F.col(c) if c in keys or (c in batch_cols and not first_cols)
            else F.col(f"_last.{c}").alias(c) if c in last_cols
            else F.col(f"_first.{c}").alias(c) if c in first_cols
            else F.lit(None).cast(target.schema[c].dataType).alias(c)
            for c in cols
        ]
    )
    b = _stamp(b, stamp)
    if keep:
        # only target rows whose key is in the batch take part in the join
        t_keep = target.join(touched, on=list(keys), how="left_semi").select(
            *keys, *[F.col(c).alias(f"_t_{c}") for c in keep], F.lit(True).alias("_hit")
        )
        b = b.join(t_keep, on=list(keys), how="left").select(
            *[
                F.when(F.col("_hit"), F.col(f"_t_{c}")).otherwise(F.col(c)).alias(c)
                if c in keep
                else F.col(c)
                for c in cols
            ]
        )
    untouched = target.join(touched, on=list(keys), how="left_anti")
    return untouched.unionByName(b.select(*cols))


def batch_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct non-NULL keys of a batch. Duplicates of a hot key are combined
    map-side, so the join side built from it has one row per key."""
    return batch.select(*keys).where(~any_null(keys)).distinct()


def _present_in(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key occurs in the batch (semi-join reduction of the target)."""
    return target.join(batch_keys(batch, keys), on=list(keys), how="left_semi")


def insert_ignore(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence | None = None,
) -> DataFrame:
    """M3: ``INSERT ... ON CONFLICT (keys) DO NOTHING``: only keys the target lacks are
    added, one row each; an existing row always wins. Within the batch the first row by
    ``order_by`` wins (M1), without it a fixed one of the key's rows."""
    b = one_per_key(batch.select(*_with(target.columns, order_by)), keys, order_by)
    b = b.select(*target.columns)
    # reduce the target to the keys the batch has before the anti join
    present = _present_in(target.select(*keys), batch, keys)
    new = b.join(present, on=list(keys), how="left_anti")
    return target.unionByName(new)


def _with(cols: Sequence[str], order_by: Sequence | None) -> list:
    """``cols`` and the order columns that are not among them."""
    return [*cols, *[o for o in order_by or [] if not isinstance(o, str) or o not in cols]]


def reload_day(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    as_of: date | datetime,
    loaded_col: str = "loaded_at",
    order_by: Sequence | None = None,
    batch_is_empty: bool | None = None,
    load_date_col: str | None = None,
) -> DataFrame:
    """M4: delete target rows loaded on or after the ``as_of`` day, then M3.

    A rerun on the same day gives the same table; rows from earlier days win over the
    batch; rows with a NULL load time stay. An empty batch changes nothing (X13): the
    check reads at most one row of the batch unless the caller passes the answer.

    When the target is partitioned by its load day, name that column in
    ``load_date_col``: the delete then becomes a partition filter and whole days of
    files are skipped instead of read. The batch gets the column too.
    """
    if batch_is_empty is None:
        batch_is_empty = batch.isEmpty()
    if batch_is_empty:
        return target
    day = as_of.date() if isinstance(as_of, datetime) else as_of
    if load_date_col:
        kept = target.where(
            F.col(load_date_col).isNull() | (F.col(load_date_col) < F.lit(day))
        )
        batch = batch.withColumn(load_date_col, F.to_date(F.col(loaded_col)))
    else:
        kept = target.where(
            F.col(loaded_col).isNull() | (F.to_date(F.col(loaded_col)) < F.lit(day))
        )
    return insert_ignore(kept, batch, keys, order_by)


def high_watermark(target: DataFrame | None, col: str, default):
    """M5: ``MAX(col)`` of the target; ``default`` when the table or column is missing or
    the table is empty. One aggregate row reaches the driver."""
    if target is None or col not in target.columns:
        return default
    value = target.agg(F.max(col)).first()[0]
    return default if value is None else value


def new_rows_since(
    source: DataFrame, col: str, watermark, inclusive: bool = False
) -> DataFrame:
    """Rows of ``source`` (names normalised, T1) after the watermark: ``col > wm``
    (strict, as the reference) or ``>=`` with ``inclusive``. The literal comparison is
    pushed into the Parquet scan."""
    src = normalize_columns(source)
    c = F.col(col)
    wm = literal_for(watermark, src.schema[col].dataType)
    return src.where(c >= wm if inclusive else c > wm)


def only_declared(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` with the columns ``cols``; other columns raise, as an INSERT naming them."""
    extra = [c for c in df.columns if c not in cols]
    if extra:
        raise SchemaError(f"columns not declared by the target: {extra}")
    return df.select(*cols)


def incremental_load(
    source: DataFrame,
    target: DataFrame,
    col: str,
    default,
    inclusive: bool = False,
    keys: Sequence[str] | None = None,
    flag_col: str | None = None,
) -> DataFrame:
    """M6: append the source rows newer than the target's high watermark (M5).

    Columns are matched by name (K3); a source column that the target lacks raises. With
    ``inclusive=True`` rows of the last loaded day are taken again and ``keys`` drop the
    ones already present, one row per key (M3), which avoids the loss the strict ``>`` has
    (X8). ``flag_col`` adds a boolean marking new rows.
    """
    wm = high_watermark(target, col, default)
    new = only_declared(new_rows_since(source, col, wm, inclusive), target.columns)
    if inclusive:
        if not keys:
            raise ValueError("inclusive loading needs keys to skip rows already present")
        new = one_per_key(new, keys, None)
        present = _present_in(target.select(*keys), new, keys)
        new = new.join(present, on=list(keys), how="left_anti")
    if flag_col:
        return target.withColumn(flag_col, F.lit(False)).unionByName(
            new.withColumn(flag_col, F.lit(True))
        )
    return target.unionByName(new)


def merge_counts(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows a merge of ``batch`` into ``target`` inserts and updates (one row).

    ``inserted`` counts distinct batch keys the target lacks plus batch rows with a NULL
    key (they never conflict); ``updated`` counts distinct batch keys the target holds.
    For insert-ignore, ``updated`` is the number of batch keys that were ignored.
    """
    hits = _present_in(target.select(*keys), batch, keys).distinct().withColumn("_hit", F.lit(True))
    keyed = batch_keys(batch, keys).join(hits, on=list(keys), how="left").select(
        F.col("_hit").isNull().alias("_ins"), F.coalesce(F.col("_hit"), F.lit(False)).alias("_upd")
    )
    loners = batch.where(any_null(keys)).select(F.lit(True).alias("_ins"), F.lit(False).alias("_upd"))
    return keyed.unionByName(loners).agg(
        F.count_if(F.col("_ins")).alias("inserted"), F.count_if(F.col("_upd")).alias("updated")
    )
