"""Change rows (insert, update, delete) folded into the rows they leave behind.

A key's state is the newest write of each column, the newest reset (an insert, which writes every column, or a
delete), and nothing else. Each of these is a maximum over the changes in their own order, so states merge by taking
maxima: it makes no difference how a log is cut into batches, in which order batches arrive, or how often a change is repeated.
Spark combines them before the shuffle, so a key with very many changes costs one row for each task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tierworks.operators.buckets import BucketedTable

#: Names of the three kinds of change.
INSERTS = ("insert", "i", "c", "r")
UPDATES = ("update", "u")
DELETES = ("delete", "d")

RESET = "_reset"


def _one_of(op: str, names: Iterable[str]) -> Column:
    return F.lower(F.col(op).cast("string")).isin(*names)


def _written(column: str) -> str:
    return f"_written_{column}"


def split_changes(changes: DataFrame, key: list[str], order: list[str], op: str) -> tuple[DataFrame, DataFrame]:
    """(changes that can be folded, all others with ``_reject_reason``): key and order must be there, ``op`` must be known."""
    reasons = [F.when(F.col(c).isNull(), F.lit(f"{c}: missing")) for c in dict.fromkeys([*key, *order])]
    known = F.coalesce(_one_of(op, (*INSERTS, *UPDATES, *DELETES)), F.lit(False))
    marked = changes.withColumn("_reject_reason", F.concat_ws("; ", *reasons, F.when(~known, F.lit(f"{op}: no kind of change"))))
    return marked.filter("_reject_reason = ''").drop("_reject_reason"), marked.filter("_reject_reason <> ''")


def change_state(changes: DataFrame, key: list[str], order: list[str], op: str) -> DataFrame:
    """One row per key: for every other column its newest write, and the key's newest reset.

    Changes are ordered by ``order`` (ascending). An update writes the columns in which it is not NULL; an insert writes
    all. Two changes of a key with the same order: a delete counts after the others, and of two values the larger one stays.
    Rows that :func:`split_changes` would reject fail the job.
    """
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in dict.fromkeys([*key, *order])])
    known = F.coalesce(_one_of(op, (*INSERTS, *UPDATES, *DELETES)), F.lit(False))
    broken = F.raise_error(F.concat(F.lit("a change without key, order or known kind: "), F.to_json(F.struct(*[F.col(c) for c in dict.fromkeys([*key, *order, op])]))))
    usable = changes.filter(F.when((missing != "") | ~known, broken).otherwise(F.lit(True)))
    at = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    inserted, deleted = _one_of(op, INSERTS), _one_of(op, DELETES)
    values = [c for c in changes.columns if c not in (*key, *order, op)]
    writes = [
        F.when(inserted | (~deleted & F.col(c).isNotNull()), F.struct(at.alias("at"), F.col(c).alias("value"))).alias(_written(c)) for c in values
    ]
    reset = F.when(inserted | deleted, F.struct(at.alias("at"), deleted.alias("gone"))).alias(RESET)
    return merge_states(usable.select(*key, reset, *writes), key)


def merge_states(states: DataFrame, key: list[str]) -> DataFrame:
    """One state per key out of any number of them."""
    return states.groupBy(*key).agg(*[F.max(c).alias(c) for c in states.columns if c not in key])


def live_rows(state: DataFrame, key: list[str]) -> DataFrame:
    """The rows that the changes leave: keys whose newest reset is no delete, with each column's newest write since.

    Updates after a delete do not bring a row back, an insert does. A key with updates only is there.
    """
    reset = F.col(RESET)
    columns = [c for c in state.columns if c.startswith(_written(""))]
    kept = [
        F.when(reset.isNull() | (F.col(f"{c}.at") >= F.col(f"{RESET}.at")), F.col(f"{c}.value")).alias(c[len(_written("")) :]) for c in columns
    ]
    return state.filter(reset.isNull() | ~F.col(f"{RESET}.gone")).select(*key, *kept)


def tombstones(state: DataFrame, key: list[str]) -> DataFrame:
    """Keys that are deleted, with the order of the delete in ``deleted_at``."""
    return state.filter(F.col(f"{RESET}.gone")).select(*key, F.col(f"{RESET}.at").alias("deleted_at"))


def fold_changes(changes: DataFrame, key: list[str], order: list[str], op: str) -> DataFrame:
    """The rows that a whole log of changes leaves; see :func:`change_state` and :func:`live_rows`."""
    return live_rows(change_state(changes, key, order, op), key)


class ChangedTable:
    """A table kept up to date by batches of changes, with tombstones, so that late changes find what they need.

    State lies in buckets of the key; a batch reads and rewrites only the buckets that its keys fall into.
    Landing a batch twice changes nothing.
    """

    def __init__(self, spark: SparkSession, root: str, key: list[str], order: list[str], op: str, buckets: int = 64) -> None:
        self.key, self.order, self.op = key, order, op
        self.table = BucketedTable(spark, root, key, buckets)

    def apply(self, changes: DataFrame) -> DataFrame:
        """Fold one batch in; returns the changes that could not be folded."""
        good, rejected = split_changes(changes, self.key, self.order, self.op)
        self.table.rewrite(change_state(good, self.key, self.order, self.op), self._merged)
        return rejected

    def _merged(self, before: DataFrame | None, fresh: DataFrame) -> DataFrame:
        return fresh if before is None else merge_states(before.unionByName(fresh, allowMissingColumns=True), self.key)

    def state(self) -> DataFrame | None:
        return self.table.read()

    def read(self) -> DataFrame | None:
        """The rows as of the last batch; None before the first."""
        state = self.table.read()
        return None if state is None else live_rows(state, self.key)
