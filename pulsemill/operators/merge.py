"""Keyed writes as pure functions: (stored rows, submitted rows) -> new stored rows.

Stored rows are unique on the key. Submitted rows may repeat a key; `order` names the columns that
say which came first. Repeats are reduced by aggregates that combine on the map side, so a key with
very many copies never reaches one task; afterwards both sides hold one row per key and the join
cannot be skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemill.plans.skew import skew_join
from pulsemill.session import scratch_path


def _others(columns: Sequence[str], *taken: Sequence[str]) -> list[str]:
    gone = {name for group in taken for name in group}
    return [c for c in columns if c not in gone]


def _pack(names: Sequence[str]) -> Column:
    return F.struct(*[F.col(n) for n in names]) if names else F.struct(F.lit(0).alias("_none"))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The earliest row of every key, whole; order columns are kept."""
    rest = _others(df.columns, keys)
    picked = df.groupBy(*keys).agg(F.min_by(_pack(rest), _pack(order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of every key, whole; order columns are kept."""
    rest = _others(df.columns, keys)
    picked = df.groupBy(*keys).agg(F.max_by(_pack(rest), _pack(order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def duplicate_source_keys(source: DataFrame, keys: Sequence[str], unit: Sequence[str] = ()) -> DataFrame:
    """Keys that one statement (`unit`, e.g. the file) submits more than once; such a statement fails."""
    counted = source.groupBy(*unit, *keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.filter(F.col("n_rows") > 1)


def insert_plain(
    target: DataFrame, source: DataFrame, keys: Sequence[str], unit: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Append statements that each take effect whole or not at all: (table, failed units with their rule).

    A unit (e.g. the set of a file) is one statement; units run in the order of their columns. A unit fails
    when it repeats a key, or submits one that is stored already, by the target or by an earlier unit that
    did not fail. A key with a NULL equals no other. Failures among units are found in rounds over the
    keys that several units submit: a unit depends on earlier ones only, so the rounds come to an end.
    """
    complete = source
    for key in keys:
        complete = complete.filter(F.col(key).isNotNull())
    pairs = complete.select(*unit, *keys).distinct()
    repeated = duplicate_source_keys(complete, keys, unit).select(*unit, F.lit("key is repeated").alias("rule"))
    taken = skew_join(pairs, target.select(*keys).distinct(), keys, "left_semi")
    found = repeated.unionByName(taken.select(*unit, F.lit("key is stored").alias("rule")))
    failed = _written(found.groupBy(*unit).agg(F.max("rule").alias("rule")), "plain-failed")

    several = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(*keys)
    clash = _written(skew_join(pairs, several, keys, "left_semi"), "plain-clash")
    base = failed
    while True:
        alive = clash.join(failed.select(*unit), list(unit), "left_anti")
        first = alive.groupBy(*keys).agg(F.min(F.struct(*unit)).alias("_first"))
        late = skew_join(clash, first, keys).filter(F.struct(*unit) > F.col("_first"))
        both = base.unionByName(late.select(*unit, F.lit("key is stored").alias("rule")))
        now = _written(both.groupBy(*unit).agg(F.max("rule").alias("rule")), "plain-failed")
        old, new = failed.select(*unit), now.select(*unit)
        changed = old.exceptAll(new).unionByName(new.exceptAll(old)).limit(1).count()
        failed = now
        if not changed:
            break
    kept = skew_join(source, failed.select(*unit), list(unit), "left_anti")
    return target.unionByName(kept.select(*target.columns)), failed


def _written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_to_insert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Submitted rows that insert-ignore really writes: the first of every new key."""
    fresh = first_per_key(source, keys, order)
    return fresh.join(target.select(*keys), list(keys), "left_anti").select(*target.columns)


def insert_ignore(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """A stored key wins over a submitted one, an earlier submitted row over a later one."""
    return target.unionByName(rows_to_insert(target, source, keys, order))


def _fold(
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    changing: Sequence[str],
    fixed: Sequence[str],
    newer_on: str | None,
) -> DataFrame:
    """One row per submitted key: the fixed columns of its first row, the changing ones of its last.

    With `newer_on`, the changing columns come from the newest row, the first of equals, and `_first`
    holds the first row: if that one inserts the key without a version, no later row replaces it.
    """
    if newer_on is None:
        folded = source.groupBy(*keys).agg(
            F.min_by(_pack(fixed), _pack(order)).alias("_fixed"),
            F.max_by(_pack(changing), _pack(order)).alias("_changing"),
        )
        return folded.select(*keys, "_fixed.*", "_changing.*").drop("_none")
    whole = _others(source.columns, keys)
    per_version = source.groupBy(*keys, F.col(newer_on).alias("_version")).agg(
        F.min_by(_pack(whole), _pack(order)).alias("_row"), F.min(_pack(order)).alias("_at")
    )
    folded = per_version.groupBy(*keys).agg(
        F.min_by("_row", "_at").alias("_first"), F.max_by("_row", "_version").alias("_newest")
    )
    return folded.select(
        *keys,
        "_first",
        *[F.col("_first")[c].alias(c) for c in fixed],
        *[F.col("_newest")[c].alias(c) for c in changing],
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    update_columns: Sequence[str] | None = None,
    preserve: Sequence[str] = (),
    newer_on: str | None = None,
    touched_only: bool = False,
) -> DataFrame:
    """Insert new keys and update stored ones.

    `update_columns` limits what an update changes (all submitted columns if None), `preserve` names
    columns an update never changes, `newer_on` updates only when that column is strictly greater
    than the stored one (NULL on either side never updates). Columns the source does not have are
    NULL on insert and untouched on update. `touched_only` returns just the rows the source names.
    """
    keys, order = list(keys), list(order)
    submitted = [c for c in source.columns if c in target.columns and c not in keys]
    changing = [c for c in (submitted if update_columns is None else update_columns) if c not in preserve]
    if newer_on is not None and newer_on not in changing:
        raise ValueError("the version column must be one of the updated columns")
    folded = _fold(source, keys, order, changing, _others(submitted, changing), newer_on)

    names = {c: f"_s_{c}" for c in folded.columns}
    new = folded.withColumnsRenamed(names).withColumn("_new", F.lit(True))
    old = target.withColumn("_old", F.lit(True))
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(key) == F.col(names[key]))
    both = old.join(new, condition, "right" if touched_only else "full")

    inserted = F.col("_old").isNull()
    applies = F.col("_new").isNotNull()
    if newer_on is not None:
        applies = applies & F.coalesce(inserted | (F.col(names[newer_on]) > F.col(newer_on)), F.lit(False))
        stuck = inserted & F.col(names["_first"])[newer_on].isNull()
    out = []
    for column in target.columns:
        if column in keys:
            out.append(F.coalesce(F.col(column), F.col(names[column])).alias(column))
        elif column not in names:
            out.append(F.col(column))
        elif column in changing:
            value = F.col(names[column])
            if newer_on is not None:
                value = F.when(stuck, F.col(names["_first"])[column]).otherwise(value)
            out.append(F.when(applies, value).otherwise(F.col(column)).alias(column))
        else:
            out.append(F.when(inserted, F.col(names[column])).otherwise(F.col(column)).alias(column))
    return both.select(*out)


def merge_by_primary_key(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Insert or update by key; columns the source does not set keep their stored value."""
    return upsert(target, source, keys, order)


def stamp_audit_columns(source: DataFrame, run_ts: Column, updated: bool = True) -> DataFrame:
    """Add the stamps of a run; `run_ts` is one literal per run, so a retried task writes the same.

    A stated update_ts is kept. An update must preserve `create_ts` (see `upsert(preserve=...)`).
    """
    out = source.withColumn("create_ts", run_ts)
    if updated and "update_ts" not in source.columns:
        out = out.withColumn("update_ts", run_ts)
    elif updated:
        out = out.withColumn("update_ts", F.coalesce("update_ts", run_ts))
    return out


def merge_column_groups(
    target: DataFrame,
    writers: dict[str, DataFrame],
    groups: dict[str, Sequence[str]],
    keys: Sequence[str],
    order: Sequence[str],
    touched_only: bool = False,
) -> DataFrame:
    """Several writers fill disjoint column groups of one row.

    The last writer of a group replaces that whole group, NULLs included, and no other group.
    """
    keys, order = list(keys), list(order)
    stacked = None
    for name, rows in writers.items():
        part = rows.select(*keys, *order, F.lit(name).alias("_writer"), *groups[name])
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    picks = [
        F.max_by(
            F.when(F.col("_writer") == name, _pack(groups[name])),
            F.when(F.col("_writer") == name, _pack(order)),
        ).alias(f"_g_{name}")
        for name in writers
    ]
    folded = stacked.groupBy(*keys).agg(*picks)
    names = {key: f"_s_{key}" for key in keys}
    new = folded.withColumnsRenamed(names)
    condition = F.lit(True)
    for key, other in names.items():
        condition = condition & (F.col(key) == F.col(other))
    both = target.join(new, condition, "right" if touched_only else "full")
    owner = {column: name for name in writers for column in groups[name]}
    out = []
    for column in target.columns:
        if column in names:
            out.append(F.coalesce(F.col(column), F.col(names[column])).alias(column))
        elif column in owner:
            written = F.col(f"_g_{owner[column]}")
            out.append(F.when(written.isNotNull(), written[column]).otherwise(F.col(column)).alias(column))
        else:
            out.append(F.col(column))
    return both.select(*out)


def returning_rows(result: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows of all submitted keys; a NULL in a key matches NULL."""
    asked = source.select(*keys).distinct()
    return skew_join(result, asked, keys, "left_semi", null_safe=True)


def maintain_latest_flag(
    target: DataFrame,
    source: DataFrame,
    per: Sequence[str],
    identity: Sequence[str],
    order: Sequence[str],
    mode: str,
    flag: str = "latest",
    preserve: Sequence[str] = ("create_ts",),
    faithful: bool = False,
) -> DataFrame:
    """Store the submitted rows and move the flag of every touched `per` key to its last arrival.

    `append` adds all rows, `update` replaces rows of equal `identity`, `ignore` keeps them. A stored
    key has at most one flagged row, so only flagged rows are joined with the touched keys, and the
    last arrivals are found by an aggregate and joined back on the complete identity: a user with
    very many rows is never gathered in one task. `faithful` repeats the original behaviour of
    `ignore`: when the last arrival is already stored, the key is left without a flagged row.
    """
    if mode not in ("append", "update", "ignore"):
        raise ValueError(f"unknown mode {mode}")
    per, identity, order = list(per), list(identity), list(order)
    touched = source.select(*per).distinct().withColumn("_touched", F.lit(True))
    flagged = F.coalesce(F.col(flag), F.lit(False))
    lowered = target.filter(flagged).join(touched, per, "left").withColumn(flag, F.col("_touched").isNull())
    stored = target.filter(~flagged).unionByName(lowered.drop("_touched"))
    last = source.groupBy(*per).agg(
        F.max_by(_pack(_others(identity, per)), _pack(order)).alias("_row")
    ).select(*per, "_row.*").drop("_none")
    body = _others(target.columns, identity, [flag])

    if mode == "append":
        merged = stored.unionByName(source.withColumn(flag, F.lit(False)).select(*target.columns))
    elif mode == "update":
        rows = source.withColumn(flag, F.lit(False))
        merged = upsert(stored, rows, identity, order, update_columns=[*body, flag], preserve=preserve)
    else:
        merged = insert_ignore(stored, source.withColumn(flag, F.lit(False)), identity, order)
        if faithful:
            last = last.join(target.select(*identity), identity, "left_anti")

    mark = last.select(*identity).withColumn("_mark", F.lit(True))
    return (
        merged.join(mark, identity, "left")
        .withColumn(flag, F.coalesce(flag, F.lit(False)) | F.col("_mark").isNotNull())
        .select(*target.columns)
    )


def ensure_dimension_rows(
    dimension: DataFrame, facts: DataFrame, key: str, needs_update_on: str | None = None
) -> DataFrame:
    """Add a minimal row for every key the facts name; `must_update` marks rows still to be filled."""
    missing = facts.select(key).filter(F.col(key).isNotNull()).distinct().join(
        dimension.select(key), key, "left_anti"
    )
    whole = dimension.unionByName(missing, allowMissingColumns=True)
    if needs_update_on is None:
        return whole
    return whole.withColumn("must_update", F.col(needs_update_on).isNull())


def fill_missing_attributes(
    dimension: DataFrame,
    source: DataFrame,
    key: str,
    attributes: Sequence[str],
    order: Sequence[str],
    guard: str,
) -> DataFrame:
    """Write all attributes, NULLs included, while the guard attribute is NULL; then never again.

    Of several submitted rows of one key, those up to the first one with a guard value count.
    """
    attributes = list(attributes)
    given = F.col(guard).isNotNull()
    folded = source.groupBy(key).agg(
        F.min_by(_pack(attributes), F.when(given, _pack(order))).alias("_first_given"),
        F.max_by(_pack(attributes), _pack(order)).alias("_last"),
    )
    new = folded.select(key, F.coalesce("_first_given", "_last").alias("_new"))
    joined = dimension.join(new, key, "left")
    opened = F.col(guard).isNull() & F.col("_new").isNotNull()
    return joined.select(
        *[
            F.when(opened, F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in attributes else F.col(c)
            for c in dimension.columns
        ]
    )


def union_writers(*parts: DataFrame) -> DataFrame:
    """Rows of several writers of one table; columns a writer does not know are NULL."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
