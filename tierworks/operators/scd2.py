"""Slowly changing dimensions, type 2, as DataFrames in and out.

A version is valid in the half-open interval ``[effective_from, effective_to)``; NULL in
``effective_to`` means still in force. Nothing is updated in place: each function returns the whole
new dimension, to be written to a new location (see :mod:`tierworks.operators.landing`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierworks.plans.sizing import measure
from tierworks.plans.skew import OrderedGroups, bounds_up_to
from tierworks.plans.workspace import settle

VALIDITY = ("effective_from", "effective_to", "is_current")
SNAPSHOT_NAMES = {"effective_from": "dbt_valid_from", "effective_to": "dbt_valid_to"}


def _moment(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def split_null_keys(df: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a whole key, rows to quarantine)."""
    missing = _any([F.col(k).isNull() for k in key])
    return df.filter(~missing), df.filter(missing)


def one_row_per_key(df: DataFrame, key: list[str]) -> DataFrame:
    """``df`` unchanged, but the job fails when a key occurs twice.

    At most two rows per key and task get past the map side, however often a key is repeated.
    """
    first = Window.partitionBy(*key).orderBy(*key)
    name = ", ".join(key)
    twice = F.raise_error(F.concat_ws("|", F.lit(f"duplicate key ({name})"), *key))
    return (
        df.withColumn("_nth", F.row_number().over(first))
        .filter(F.col("_nth") <= 2)
        .filter(F.when(F.col("_nth") > 1, twice).otherwise(F.lit(True)))
        .drop("_nth")
    )


def first_versions(incoming: DataFrame, key: list[str], as_of) -> DataFrame:
    """The dimension of the first batch: every row in force from ``as_of``."""
    start = _moment(as_of)
    return one_row_per_key(split_null_keys(incoming, key)[0], key).select(
        *incoming.columns,
        start.alias("effective_from"),
        F.lit(None).cast(incoming.select(start.alias("t")).schema["t"].dataType).alias("effective_to"),
        F.lit(True).alias("is_current"),
    )


def scd2_apply(
    dim: DataFrame | None,
    incoming: DataFrame,
    key: list[str],
    tracked: list[str],
    as_of,
    null_safe: bool = True,
    close_missing: bool = False,
) -> DataFrame:
    """The dimension after one batch.

    * a current row whose ``tracked`` columns differ from the batch is closed at ``as_of`` and its new
      version starts there;
    * a key that is not current yet starts at ``as_of``;
    * everything else stays, including keys the batch does not mention (unless ``close_missing``).

    Other columns change only together with a tracked one. ``null_safe=False`` compares with ``<>``,
    under which a change from or to NULL goes unnoticed. An ``as_of`` that is not after the start of a version
    it would close fails the job. Rows with a NULL key are left out (see
    :func:`split_null_keys`); a key that occurs twice in the batch fails the job.

    Only current rows are joined; history passes by. A batch measured to be small is broadcast, and
    then the stored dimension is not shuffled at all. A large one meets it in a full outer join.
    """
    if dim is None:
        return first_versions(incoming, key, as_of)
    attributes = [c for c in dim.columns if c not in VALIDITY]
    at = _moment(as_of).cast(dim.schema["effective_from"].dataType)
    running = F.coalesce(F.col("is_current"), F.lit(False))
    history, current = dim.filter(~running), dim.filter(running)

    usable = split_null_keys(incoming.select(*attributes), key)[0]
    batch = measure(one_row_per_key(usable, key))
    old, new = [f"_old_{c}" for c in attributes], [f"_new_{c}" for c in attributes]
    old_key, new_key = [f"_old_{k}" for k in key], [f"_new_{k}" for k in key]
    arriving = batch.df.withColumnsRenamed(dict(zip(attributes, new)))
    arriving = arriving.withColumn("_arrived", F.lit(True))
    standing = current.withColumnsRenamed(dict(zip(attributes, old)))
    standing = standing.withColumn("_stood", F.lit(True))
    on = [F.col(a) == F.col(b) for a, b in zip(old_key, new_key)]

    pairs = standing.join(
        F.broadcast(arriving) if batch.small else arriving, on, "left" if batch.small else "full_outer"
    )
    stood, arrived = F.col("_stood").isNotNull(), F.col("_arrived").isNotNull()
    if null_safe:
        differs = _any([~F.col(f"_old_{c}").eqNullSafe(F.col(f"_new_{c}")) for c in tracked])
    else:
        differs = _any([F.col(f"_old_{c}") != F.col(f"_new_{c}") for c in tracked])
    changed = stood & arrived & F.coalesce(differs, F.lit(False))
    closed = (changed | (stood & ~arrived)) if close_missing else changed

    def version(names: list[str], start: Column, end: Column, live: Column) -> Column:
        fields = [F.col(n).alias(c) for n, c in zip(names, attributes)]
        return F.struct(
            *fields, start.alias("effective_from"), end.alias("effective_to"), live.alias("is_current")
        )

    never = F.lit(None).cast(dim.schema["effective_to"].dataType)
    backward = F.raise_error(F.concat_ws("|", F.lit("as_of is not after the start of the standing version"), *old_key))
    kept = version(
        old,
        F.col("effective_from"),
        F.when(closed & (F.col("effective_from") >= at), backward.cast(dim.schema["effective_to"].dataType))
        .when(closed, at)
        .otherwise(F.col("effective_to")),
        ~closed,
    )
    opened = version(new, at, never, F.lit(True))
    both = F.array_compact(
        F.array(F.when(stood, kept), F.when(changed | (arrived & ~stood), opened))
    )
    result = history.unionByName(pairs.select(F.inline(both)).select(*dim.columns))
    if batch.small:
        known = current.join(
            F.broadcast(batch.df.select(*[F.col(k).alias(n) for k, n in zip(key, new_key)])),
            [F.col(k) == F.col(n) for k, n in zip(key, new_key)],
            "left_semi",
        ).select(*key)
        # At most one current row per key of the batch, so no larger than the batch itself.
        fresh = batch.df.join(F.broadcast(known), key, "left_anti").select(
            *attributes, at.alias("effective_from"), never.alias("effective_to"), F.lit(True).alias("is_current")
        )
        result = result.unionByName(fresh.select(*dim.columns))
    return result


def scd2_snapshot(
    dim: DataFrame | None, incoming: DataFrame, key: list[str], check_cols: list[str], as_of
) -> DataFrame:
    """The same versioning under snapshot names: ``dbt_valid_from``, ``dbt_valid_to``, ``dbt_scd_id``.

    NULL in ``dbt_valid_to`` marks the current version; the surrogate key is a digest of the business
    key and the start of the version.
    """
    if dim is not None:
        back = {v: k for k, v in SNAPSHOT_NAMES.items()}
        dim = dim.drop("dbt_scd_id").withColumnsRenamed(back)
        dim = dim.withColumn("is_current", F.col("effective_to").isNull())
    applied = scd2_apply(dim, incoming, key, check_cols, as_of).drop("is_current")
    start = F.date_format("dbt_valid_from", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    # As JSON, so that neither a separator within a key nor a NULL makes two keys look alike.
    parts = F.to_json(F.array(*[F.col(k).cast("string") for k in key], start))
    return applied.withColumnsRenamed(SNAPSHOT_NAMES).withColumn("dbt_scd_id", F.md5(parts))


def scd2_rebuild(
    log: DataFrame,
    key: list[str],
    tracked: list[str],
    batch_ts: str,
    rows_per_task: int | None = None,
) -> DataFrame:
    """The dimension from the whole append-only log at once, one version per batch that changed it.

    Equal to applying the batches one after the other. ``log`` holds one row per key and batch; two
    rows of a key at the same time fail the job.
    """
    usable = split_null_keys(log, key)[0]
    ordered = OrderedGroups(usable, key, [batch_ts], rows_per_task)
    seen = ordered.neighbour(ordered.rows, F.struct(batch_ts, *tracked), "_previous")
    twice = F.raise_error(F.concat_ws("|", F.lit("two rows of one key in a batch"), *key))
    moved = _any([~F.col(c).eqNullSafe(F.col(f"_previous.{c}")) for c in tracked])
    changes = (
        seen.filter(
            F.when(F.col("_previous").isNull(), F.lit(True))
            .when(F.col(f"_previous.{batch_ts}").eqNullSafe(F.col(batch_ts)), twice)
            .otherwise(moved)
        )
        .drop("_previous")
    )
    versions = ordered.neighbour(changes, F.struct(batch_ts), "_next", following=True)
    return ordered.done(
        versions.withColumn("effective_to", F.col(f"_next.{batch_ts}"))
        .withColumn("is_current", F.col("_next").isNull())
        .withColumnRenamed(batch_ts, "effective_from")
        .drop("_next")
    )


def scd2_current(dim: DataFrame) -> DataFrame:
    """Versions in force now."""
    return dim.filter(F.col("effective_to").isNull())


def scd2_as_of(dim: DataFrame, ts) -> DataFrame:
    """Versions that were in force at ``ts``."""
    at = _moment(ts)
    return dim.filter(
        (F.col("effective_from") <= at) & (F.col("effective_to").isNull() | (at < F.col("effective_to")))
    )


def join_as_of(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    fact_ts: str,
    *,
    broadcast: bool | None = None,
    rows_per_task: int | None = None,
) -> DataFrame:
    """Inner join of each fact row with the version of its key that was valid at ``fact_ts``.

    Versions of a key must not overlap: two that do fail the job. Versions without a key or a start, and empty ones
    (that end when they begin, or before), are never valid. Facts without a key or a time match nothing.

    A dimension that is measured to be small is broadcast as one row per key with its versions in order, and each fact
    bisects them, so facts are not shuffled. Otherwise facts and versions are brought into one order per key and
    each fact takes the last version that began. Neither way compares a fact with every version of
    its key, and both give the same rows. ``broadcast`` overrides the choice.
    """
    begins, ends = F.col("effective_from"), F.col("effective_to")
    usable = dim.filter(F.col(dim_key).isNotNull() & begins.isNotNull() & (ends.isNull() | (begins < ends)))
    versions = measure(usable.withColumnRenamed(dim_key, "_dim_key"))
    if versions.small if broadcast is None else broadcast:
        return _by_bisection(fact, versions.df, fact_key, fact_ts)
    return _by_order(fact, versions.df, fact_key, fact_ts, rows_per_task)


def _overlap(key: Column) -> Column:
    return F.raise_error(F.concat_ws("|", F.lit("overlapping versions of one key"), key))


def _by_bisection(facts: DataFrame, versions: DataFrame, fact_key: str, fact_ts: str) -> DataFrame:
    row = F.struct(*[c for c in versions.columns if c != "_dim_key"])

    def earlier_first(a: Column, b: Column) -> Column:
        return F.when(a["effective_from"] < b["effective_from"], -1).when(a["effective_from"] > b["effective_from"], 1).otherwise(0)

    def reaches_next(n: Column) -> Column:
        end, following = F.get("_versions", n)["effective_to"], F.get("_versions", n + 1)["effective_from"]
        return end.isNull() | (end > following)

    per_key = versions.groupBy("_dim_key").agg(F.array_sort(F.collect_list(row), earlier_first).alias("_versions"))
    pairs = F.filter(F.sequence(F.lit(0), F.size("_versions") - 1), lambda n: n < F.size("_versions") - 1)
    per_key = settle(
        per_key.filter(F.when(F.exists(pairs, reaches_next), _overlap(F.col("_dim_key"))).otherwise(F.lit(True))).withColumn(
            "_starts", F.transform("_versions", lambda v: v["effective_from"])
        )
    )
    most = per_key.agg(F.max(F.size("_starts"))).first()[0] or 0
    nth = bounds_up_to(F.col(fact_ts), F.col("_starts"), most)
    joined = facts.join(F.broadcast(per_key), F.col(fact_key) == F.col("_dim_key"))
    hit = joined.select(*facts.columns, F.get("_versions", nth - 1).alias("_valid"))
    ends = F.col("_valid.effective_to")
    hit = hit.filter(F.col("_valid").isNotNull() & (ends.isNull() | (F.col(fact_ts) < ends)))
    return hit.select(*facts.columns, "_valid.*")


def _by_order(
    facts: DataFrame, versions: DataFrame, fact_key: str, fact_ts: str, rows_per_task: int | None
) -> DataFrame:
    in_order = OrderedGroups(versions, ["_dim_key"], ["effective_from", "effective_to"], rows_per_task)
    following = in_order.neighbour(in_order.rows, F.struct("effective_from"), "_next", following=True)
    clash = F.col("_next").isNotNull() & (
        F.col("effective_to").isNull() | (F.col("effective_to") > F.col("_next.effective_from"))
    )
    versions = in_order.done(following.filter(F.when(clash, _overlap(F.col("_dim_key"))).otherwise(F.lit(True))).drop("_next"))
    fact_row = F.struct(*facts.columns)
    dim_row = F.struct(*[c for c in versions.columns if c != "_dim_key"])
    known = facts.filter(F.col(fact_ts).isNotNull() & F.col(fact_key).isNotNull())
    started = versions.select(
        F.col("_dim_key").alias("_k"),
        F.col("effective_from").alias("_at"),
        F.lit(0).alias("_turn"),
        F.lit(None).cast(facts.select(fact_row.alias("r")).schema["r"].dataType).alias("_fact"),
        dim_row.alias("_version"),
    )
    asked = known.select(
        F.col(fact_key).alias("_k"),
        F.col(fact_ts).alias("_at"),
        F.lit(1).alias("_turn"),
        fact_row.alias("_fact"),
        F.lit(None).cast(started.schema["_version"].dataType).alias("_version"),
    )
    # The digest only spreads facts of one instant over cells; versions still come before facts.
    line = started.unionByName(asked).withColumn("_spread", F.xxhash64("_fact"))
    ordered = OrderedGroups(line, ["_k"], ["_at", "_turn", "_spread"], rows_per_task)
    seen = ordered.last_seen(ordered.rows, F.col("_version"), "_valid")
    ends = F.col("_valid.effective_to")
    hits = seen.filter(
        (F.col("_turn") == 1)
        & F.col("_valid").isNotNull()
        & (ends.isNull() | (F.col("_at") < ends))
    )
    return hits.select("_fact.*", "_valid.*")
