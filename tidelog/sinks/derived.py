"""Rows derived from keyed parents: a change of a parent replaces all rows that were derived from it."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators.relational import latest_per_key
from tidelog.sinks.keyed import KeyedTable, version_of

_BATCH, _GONE = "_batch", "_gone"


class _Children(KeyedTable):
    """Rows with the parent's key and the batch they came from; those of the batch that the parent is from count."""

    def __init__(self, spark, path, parents: KeyedTable):
        super().__init__(spark, path, parents.keys, buckets=parents.wanted_buckets)
        self.parents = parents

    def _merged(self, df: DataFrame, order: Sequence[str]) -> DataFrame:
        current = self.parents.rows().select(*[F.col(k).alias(f"_of_{k}") for k in self.keys], F.col(_BATCH).alias("_of"))
        same = reduce(
            lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in self.keys], F.col(_BATCH) == F.col("_of")
        )
        return df.join(current, same, "left_semi")

    def _alone(self, rows: DataFrame) -> DataFrame:
        return self._merged(rows, ()).drop("_version")


class DerivedTable:
    """A table of children that follows a feed of changes of their parents.

    For each parent the newest change counts, by the `sequence` columns and then by batch. Its children are what
    the batch of that change derived from it; the children of older changes vanish, and where the newest change
    satisfies `deleted`, a condition in SQL, all do. A change that comes late has no effect, and a batch
    that runs again, or a new checkpoint that reads all changes again, adds nothing twice.

    Batches only write their own rows; `read` joins children with their parents' versions, and `compact`
    rewrites the buckets that batches have touched, without the children that vanished.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        sequence: Sequence[str],
        deleted: str,
        buckets: int | None = None,
    ):
        self.spark, self.path, self.deleted = spark, path.rstrip("/"), deleted
        self.parents = KeyedTable(spark, f"{self.path}/parents", keys, None, sequence, _GONE, buckets)
        self.children = _Children(spark, f"{self.path}/children", self.parents)

    def apply(
        self, changes: DataFrame, derive: Callable[[DataFrame], DataFrame], batch: int, writer: str | None = None
    ) -> None:
        """Take in a batch of changes; `derive` makes children, which keep the parents' key columns."""
        keys, sequence = self.parents.keys, self.parents.sequence
        version = version_of(self.spark, self.path, writer, batch)
        newest = latest_per_key(changes, keys, sequence)
        gone = F.coalesce(F.expr(self.deleted), F.lit(False))
        mark = F.lit(version).cast("bigint").alias(_BATCH)
        # children first: until its parent is there, a child is not seen
        self.children.upsert(derive(newest.filter(~gone)).select("*", mark), version)
        self.parents.upsert(newest.select(*keys, *[c for c in sequence if c not in keys], gone.alias(_GONE), mark), version)

    def read(self) -> DataFrame | None:
        """The children of all parents as they are now."""
        if self.parents.read() is None:
            return None
        found = self.children.read()
        return None if found is None else found.drop(_BATCH)

    def compact(self) -> None:
        self.parents.compact()
        self.children.compact()

    def open_batches(self) -> int:
        return self.children.open_batches()
