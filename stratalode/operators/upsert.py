"""Incremental loads: schema alignment, merging by key, soft deletes."""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalode.functions.names import (
    DELETED_AT,
    as_list,
    column,
    is_technical,
    lookup,
    spare_name,
)
from stratalode.operators.clean import filter_soft_deleted
from stratalode.operators.dedup import dedup_latest, keep_first, newest_first, resolve_keys

# The first of these that exists orders the rows of a merge.
MERGE_RECENCY_COLUMNS = ("_ab_cdc_updated_at", "updated_at", "_ab_updated_at")


def align_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Add the columns only ``source`` has to ``target``, as NULL of the same type.

    Names are compared ignoring case.
    """
    missing = [f for f in source.schema.fields if lookup(target.columns, f.name) is None]
    if not missing:
        return target
    return target.select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]
    )


def merge_dedup(
    existing: DataFrame,
    incoming: DataFrame,
    keys: str | Iterable[str] | None = None,
    order_by: str | Iterable[str] | None = None,
    catalog: Mapping | None = None,
    existing_is_unique: bool = False,
) -> DataFrame:
    """Stack incoming rows on existing ones and keep one row per key.

    Rows marked as deleted are not taken in. The newest row wins; without a
    recency column, or on a tie, the incoming one does. Columns one side lacks
    are NULL there.

    With ``existing_is_unique=True``, the incoming rows are reduced to the newest
    per key and joined to ``existing``, which is read once, and once more for its
    keys alone. A small increment then leaves a large table unshuffled, as Spark
    broadcasts it when it is below its size threshold.
    """
    incoming = filter_soft_deleted(incoming)
    keys = resolve_keys(existing, keys, catalog)
    existing = align_columns(existing, incoming)
    if existing_is_unique:
        return _merge_unique(existing, incoming, keys, order_by)
    is_new = spare_name(existing.columns, "_is_new")
    stacked = existing.withColumn(is_new, F.lit(False)).unionByName(
        incoming.withColumn(is_new, F.lit(True)), allowMissingColumns=True
    )
    recency = _merge_recency(stacked.columns, order_by)
    return keep_first(stacked, keys, newest_first(stacked, keys, [*recency, is_new])).drop(is_new)


def _merge_recency(columns: list[str], order_by: str | Iterable[str] | None) -> list[str]:
    offered = as_list(order_by) or [c for c in MERGE_RECENCY_COLUMNS if c in columns][:1]
    return [c for c in offered if c in columns]


def _is_newer(left: list[Column], right: list[Column]) -> Column:
    """Whether ``left`` comes strictly later in lexicographic order, NULL being the oldest."""
    newer = F.lit(False)
    for a, b in reversed(list(zip(left, right, strict=True))):
        later = F.coalesce(a > b, a.isNotNull() & b.isNull())
        newer = later | (a.eqNullSafe(b) & newer)
    return newer


def _merge_unique(
    existing: DataFrame, incoming: DataFrame, keys: list[str], order_by: str | Iterable[str] | None
) -> DataFrame:
    """`merge_dedup` for a table that holds each key once: read once, plus its keys alone."""
    recency = _merge_recency([*existing.columns, *incoming.columns], order_by)
    known = [c for c in recency if c in incoming.columns]
    newest = keep_first(incoming, keys, newest_first(incoming, keys, known))
    taken = [*existing.columns, *incoming.columns]
    renamed = {c: spare_name(taken, f"_new_{c}") for c in incoming.columns}
    came = spare_name(taken, "_came")
    right = newest.select(
        *[column(c).alias(name) for c, name in renamed.items()], F.lit(True).alias(came)
    )
    # Rows are grouped by key, and groups hold NULL keys together.
    same_key = reduce(and_, [column(k).eqNullSafe(column(renamed[lookup(incoming.columns, k)])) for k in keys])
    paired = existing.join(right, same_key, "left")

    def new(name: str) -> Column:
        found = lookup(incoming.columns, name)
        return column(renamed[found]) if found else F.lit(None)

    stored = [column(c) for c in recency]
    taken_over = F.coalesce(column(came), F.lit(False)) & ~_is_newer(stored, [new(c) for c in recency])
    kept = paired.select(
        *[F.when(taken_over, new(c)).otherwise(column(c)).alias(c) for c in existing.columns]
    )
    stored_keys = existing.select(*[column(k).alias(f"_stored_{k}") for k in keys])
    met = reduce(and_, [column(k).eqNullSafe(column(f"_stored_{k}")) for k in keys])
    inserts = newest.join(stored_keys, met, "left_anti")
    return kept.unionByName(inserts, allowMissingColumns=True)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: str | Iterable[str] | None = None,
    order_by: str | Iterable[str] | None = None,
    deleted_column: str = DELETED_AT,
    catalog: Mapping | None = None,
    keep_recency: bool = False,
    staged: bool = True,
) -> DataFrame:
    """Apply a change feed to a table by key.

    A matched row is removed when the change is a deletion, else its business
    columns take the change's values; other columns of the target keep theirs.
    An unmatched change is inserted unless it is a deletion. Several changes of
    one key count as the newest of them; changes without a whole key match nothing
    and are inserted, each of them.

    ``keep_recency=True`` keeps the columns that tell recency, technical ones too,
    and leaves a row alone that is newer than its change. A deleted key leaves no
    trace here: a change of it that arrives later inserts it again, unless
    `live_changes` has sorted it out.

    The newest changes are needed by two joins. They are written to the session's
    shared folder, so that the feed is read once; ``staged=False`` prevents it.

    Both joins keep the target on the left and hold one row per key on the
    right. Spark can therefore split a key the target repeats, and a small feed
    is broadcast, leaving the target where it is.
    """
    from stratalode.sinks.stage import stage  # the sinks import this module

    keys = resolve_keys(target, keys, catalog)
    whole_key = reduce(and_, [column(k).isNotNull() for k in keys])
    changes = dedup_latest(source.filter(whole_key), keys, order_by).unionByName(
        source.filter(~whole_key)
    )
    if staged:
        changes = stage(changes, "changes")
    recency = [c for c in _merge_recency(source.columns, order_by) if c in source.columns] if keep_recency else []
    deleted = (
        column(deleted_column).isNotNull() if deleted_column in source.columns else F.lit(False)
    )
    business = [
        c for c in source.columns if (not is_technical(c) or c in recency) and c != deleted_column
    ]
    updated = [c for c in business if lookup(keys, c) is None]

    taken = [*target.columns, *source.columns]
    is_change = spare_name(taken, "_is_change")
    is_deletion = spare_name(taken, "_is_deletion")
    incoming = {c: spare_name(taken, f"_new_{c}") for c in [*keys, *updated]}
    right = changes.filter(whole_key).select(
        *[column(c).alias(name) for c, name in incoming.items()],
        F.lit(True).alias(is_change),
        deleted.alias(is_deletion),
    )
    compared = [c for c in recency if c in target.columns]
    outdated = _is_newer([column(c) for c in compared], [column(incoming[c]) for c in compared])
    same_key = reduce(and_, [column(k) == column(incoming[k]) for k in keys])
    paired = target.join(right, same_key, "left").filter(
        F.coalesce(~column(is_deletion) | outdated, F.lit(True))
    )

    def merged(name: str):
        change = lookup(updated, name)
        if change is None:
            return column(name)
        new = column(incoming[change]).cast(target.schema[name].dataType)
        return F.when(column(is_change) & ~outdated, new).otherwise(column(name)).alias(name)

    added = [c for c in updated if lookup(target.columns, c) is None]
    kept = paired.select(
        *map(merged, target.columns), *[column(incoming[c]).alias(c) for c in added]
    )
    changed_keys = changes.select(*keys).distinct()
    known = target.select(*keys).join(changed_keys, keys, "left_semi").distinct()
    inserts = changes.filter(~deleted).join(known, keys, "left_anti").select(*map(column, business))
    return kept.unionByName(inserts, allowMissingColumns=True)


def merge_buckets(
    existing: DataFrame,
    incoming: DataFrame,
    keys: str | Iterable[str],
    buckets: int,
    order_by: str | Iterable[str] | None = None,
    how: str = "dedup",
    deleted_column: str = DELETED_AT,
) -> DataFrame:
    """`merge_dedup` or `merge_upsert` for a table that holds each key once, in buckets of its keys.

    The incoming rows are shuffled to the table's buckets, reduced to the newest per
    key and joined by a full outer join: stored rows stay where they are, in the
    order they have, and come out in the same buckets. Rows whose key has a NULL
    cannot meet in such a join. They are merged on their own; a filter on the key
    keeps all others out of that, down to the scan.

    With ``how="upsert"`` the columns that tell recency are kept, as in snapshots.
    """
    if how not in ("dedup", "upsert"):
        raise ValueError(f"how must be 'dedup' or 'upsert', not {how!r}")
    keys = resolve_keys(existing, keys)
    own_keys = [lookup(incoming.columns, k) for k in keys]
    whole, own_whole = (reduce(and_, [column(k).isNotNull() for k in names]) for names in (keys, own_keys))
    if how == "dedup":
        incoming = filter_soft_deleted(incoming)
        existing = align_columns(existing, incoming)
        keyless = merge_dedup(existing.filter(~whole), incoming.filter(~own_whole), keys, order_by)
    else:
        keyless = merge_upsert(
            existing.filter(~whole), incoming.filter(~own_whole), keys, order_by, deleted_column, keep_recency=True, staged=False
        )
    recency = _merge_recency([*existing.columns, *incoming.columns], order_by)
    known = [c for c in recency if c in incoming.columns]
    dealt = incoming.filter(own_whole).repartition(buckets, *map(column, own_keys))
    newest = (
        keep_first(dealt, own_keys, newest_first(dealt, own_keys, known)) if how == "dedup" else dedup_latest(dealt, own_keys, order_by)
    )
    taken = [*existing.columns, *incoming.columns]
    renamed = {c: spare_name(taken, f"_new_{c}") for c in incoming.columns}
    came, stays = spare_name(taken, "_came"), spare_name(taken, "_stays")
    right = newest.select(*[column(c).alias(name) for c, name in renamed.items()], F.lit(True).alias(came))
    left = existing.filter(whole).withColumn(stays, F.lit(True))
    paired = left.join(right, reduce(and_, [column(k) == column(renamed[n]) for k, n in zip(keys, own_keys, strict=True)]), "full_outer")

    def new(name: str) -> Column:
        found = lookup(incoming.columns, name)
        return column(renamed[found]) if found else F.lit(None)

    compared = recency if how == "dedup" else [c for c in known if c in existing.columns]
    outdated = column(stays).isNotNull() & _is_newer([column(c) for c in compared], [new(c) for c in compared])
    taken_over = column(came).isNotNull() & ~outdated
    if how == "dedup":
        merged = [F.when(taken_over, new(c)).otherwise(column(c)).alias(c) for c in existing.columns]
        return paired.select(*merged).unionByName(keyless, allowMissingColumns=True)
    if deleted_column in incoming.columns:
        paired = paired.filter(~(taken_over & new(deleted_column).isNotNull()))
    business = [c for c in incoming.columns if (not is_technical(c) or c in recency) and c != deleted_column]

    def upserted(name: str) -> Column:
        change = lookup(business, name)
        value = column(name) if change is None else F.when(taken_over, new(change).cast(existing.schema[name].dataType)).otherwise(column(name))
        return value.alias(name)

    added = [new(c).alias(c) for c in business if lookup(existing.columns, c) is None]
    return paired.select(*map(upserted, existing.columns), *added).unionByName(keyless, allowMissingColumns=True)


DELETED_ON = "_deleted_on"


def live_changes(
    changes: DataFrame, tombstones: DataFrame, keys: str | Iterable[str], order_by: str | Iterable[str] | None = None
) -> DataFrame:
    """The changes that are newer than their key's deletion, or whose key was not deleted.

    ``tombstones`` hold deleted keys with the recency of their deletion, which also
    wins a tie. Changes without a whole key have none.
    """
    recency = deletion_recency(changes, order_by)
    keys = as_list(keys)
    taken = [*changes.columns, *tombstones.columns]
    gone = {c: spare_name(taken, f"_gone_{c}") for c in [*keys, *recency]}
    found = spare_name(taken, "_gone")
    right = tombstones.select(*[column(c).alias(name) for c, name in gone.items()], F.lit(True).alias(found))
    paired = changes.join(right, reduce(and_, [column(k) == column(gone[k]) for k in keys]), "left")
    newer = _is_newer([column(c) for c in recency], [column(gone[c]) for c in recency])
    return paired.filter(column(found).isNull() | newer).select(*map(column, changes.columns))


def next_tombstones(
    stored: DataFrame,
    changes: DataFrame,
    tombstones: DataFrame | None,
    keys: str | Iterable[str],
    day: datetime.date,
    order_by: str | Iterable[str] | None = None,
    deleted_column: str = DELETED_AT,
) -> DataFrame:
    """The deleted keys after a day's changes: those of before, and the day's own.

    ``changes`` hold the newest change per key, those older than a deletion left out.
    A deletion leaves a tombstone, also of a key that is not stored, but not if the
    stored row is newer; any other change of a key takes its tombstone away.
    """
    keys, recency = as_list(keys), deletion_recency(changes, order_by)
    whole = changes.filter(reduce(and_, [column(k).isNotNull() for k in keys]))
    compared = [c for c in recency if c in stored.columns]
    gone = whole.filter(column(deleted_column).isNotNull()) if deleted_column in changes.columns else whole.limit(0)
    gone = gone.select(*keys, *recency)
    if compared:
        kept = stored.select(*[column(k).alias(f"_stored_{k}") for k in keys], *[column(c).alias(f"_at_{c}") for c in compared])
        same = reduce(and_, [column(k) == column(f"_stored_{k}") for k in keys])
        newer = _is_newer([column(f"_at_{c}") for c in compared], [column(c) for c in compared])
        gone = gone.join(kept, same & newer, "left_anti")
    gone = gone.withColumn(DELETED_ON, F.lit(day))
    if tombstones is None:
        return gone
    left = tombstones.join(whole.select(*keys), keys, "left_anti")
    return gone.unionByName(left.select(*gone.columns))


def deletion_recency(changes: DataFrame, order_by: str | Iterable[str] | None = None) -> list[str]:
    found = [c for c in _merge_recency(changes.columns, order_by) if c in changes.columns]
    if not found:
        raise ValueError(f"deletions are kept with the recency of their change, and none of {changes.columns} tells it; pass order_by")
    return found
