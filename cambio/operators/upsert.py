"""MERGE as a DataFrame composition: update the matched rows, insert the others, delete nothing."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A source is broadcast only while its row count times its row width stays below this.
BROADCAST_BYTES = 64 * 1024 * 1024


#: Shuffle partitions per value of ``cluster``, so that a table of few parts is still written, and read again, by many tasks.
SPREAD = 8


class AmbiguousMerge(ValueError):
    """Two source rows carry the same key, so a target row could be updated twice."""


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their count. Partial counts first, so a hot key is no problem."""
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def count_source(source: DataFrame, keys: Sequence[str]) -> int:
    """Count the source and check that no key repeats, in one job over the key columns; one row reaches the driver."""
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    facts = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.max("n"), F.lit(0)).alias("most")
    ).first()
    if facts.most > 1:
        example = duplicate_keys(source, keys).first().asDict()
        raise AmbiguousMerge(f"the merge source has several rows for one key, such as {example}")
    return facts.rows


def require_unique_keys(source: DataFrame, keys: Sequence[str]) -> None:
    count_source(source, keys)


def fits_broadcast(rows: int | None, row_bytes: int) -> bool:
    """Whether a relation of a *counted* number of rows may be broadcast; an uncounted one may not."""
    return rows is not None and rows * row_bytes <= BROADCAST_BYTES


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    matched: Mapping[str, Column],
    inserted: Mapping[str, Column],
    broadcast_source: bool = False,
    cluster: Column | None = None,
    ordered_by: str | None = None,
    combined: Mapping[str, Callable[[Column, Column], Column]] | None = None,
) -> DataFrame:
    """Target after the merge, in the target's columns and types.

    ``matched`` and ``inserted`` give, per target column, an expression over the source; a column without one keeps its
    value (matched) or becomes NULL (inserted). Keys compare with ``=``: NULL keys never match. The source must have one
    row per key (:func:`require_unique_keys`); the target may hold duplicates, each of which is updated.

    ``ordered_by`` names a column that both sides have: a match whose source row is older than the target row by it changes
    nothing, so sources may come in any order. What has to change all the same is in ``combined``: per column a function of
    the target's value and the new one.

    With ``broadcast_source`` the target is neither shuffled nor sorted: matches are found by a broadcast left join, and
    the keys already present by a broadcast semi join. Otherwise both sides are shuffled on the keys. That plan uses a
    left join for the updates, not a full outer one, because adaptive execution can then split a target partition that a
    hot or NULL key has swollen; and the keys compared for the inserts are made distinct first, map-side.

    ``cluster``, an expression over the target's columns, brings rows together before a write that splits them by it;
    otherwise every task would write a sliver of every partition. With ``broadcast_source`` the kept rows stay where the
    target has them and only the inserted rows are moved; in the shuffled plan the join has scattered all rows, so all
    are moved. A value's rows go to :data:`SPREAD` partitions by their keys; adaptive execution joins the small ones and
    splits one that is swollen.
    """
    types = {f.name: f.dataType for f in target.schema.fields}
    hint = F.broadcast if broadcast_source else (lambda frame: frame)

    updates = source.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.lit(True).alias("_matched"),
        *[expr.cast(types[c]).alias(f"_new_{c}") for c, expr in matched.items()],
    )
    combined = combined or {}
    # an explicit match flag decides, never the value: a NULL in the source has to overwrite
    replaces = F.col("_matched")
    if ordered_by:
        replaces &= ~F.coalesce(target[ordered_by] > F.col(f"_new_{ordered_by}"), F.lit(False))

    def after(c: str) -> Column:
        if c in combined:
            return F.when(F.col("_matched"), combined[c](target[c], F.col(f"_new_{c}"))).otherwise(target[c])
        return F.when(replaces, F.col(f"_new_{c}")).otherwise(target[c]) if c in matched else target[c]

    joined = target.join(hint(updates), _same(target, updates, keys), "left")
    kept = joined.select(*[after(c).alias(c) for c in target.columns])

    present = target.select(*keys)  # Catalyst drops its NULL keys: they cannot match
    if broadcast_source:
        present = present.join(F.broadcast(source.select(*keys)), list(keys), "left_semi")
    # in the shuffled plan a semi join before the distinct would keep adaptive execution from splitting a hot target key
    present = present.distinct()
    # at most one row per source key is left in the broadcast case, so the same bound holds for it
    new = source.join(hint(present), list(keys), "left_anti").select(
        *[
            (inserted[c].cast(types[c]) if c in inserted else F.lit(None).cast(types[c])).alias(c)
            for c in target.columns
        ]
    )
    if cluster is None:
        return kept.unionByName(new)
    if broadcast_source:
        return kept.unionByName(_together(new, cluster, keys))
    return _together(kept.unionByName(new), cluster, keys)


def _together(rows: DataFrame, cluster: Column, keys: Sequence[str]) -> DataFrame:
    spread = rows.withColumns({"_cluster": cluster, "_spread": F.pmod(F.xxhash64(*keys), F.lit(SPREAD))})
    return spread.hint("rebalance", F.col("_cluster"), F.col("_spread")).drop("_cluster", "_spread")


def _same(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [target[k] == updates[f"_key_{k}"] for k in keys])
