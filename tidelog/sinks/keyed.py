"""A keyed table on plain files that takes upserts batch by batch.

Each batch writes only its own changed rows, into a folder named after its version, and
replaces that folder when it runs again. Reading merges the batches per key. So an
upsert costs as much as its batch and not as much as the table, a replay adds nothing
twice, and a batch that failed half way is not seen (its folder has no _SUCCESS mark).

A version is the number of the writer and the number of its batch. Streaming queries are
told apart by their id, which lives in the checkpoint: a query with a new checkpoint is
another writer, whose batches follow those of the writers before it.

`compact` merges what is there into a base, which bounds the work of later reads, and
deletes what the base before covers; readers that began before still find their files.

Rows lie in buckets by a hash of their key. A reader that names the keys it asks for opens
their buckets only, and a compaction rewrites only the buckets that batches have touched; the
others stay in the base they are in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.relational import latest_per_key

_MERGES = {"sum": F.sum, "min": F.min, "max": F.max}
_VERSION = "_version"
_BUCKET = "_bucket"
#: buckets of a table that does not say how many; a table keeps the number it was made with
BUCKETS = 16
_BATCHES = 10**9  # numbers of one writer


def hadoop_folder(spark: SparkSession, name: str):
    """(path classes, path, its file system) of a folder."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(name)
    return hadoop, path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def version_of(spark: SparkSession, path: str, writer: str | None, batch: int) -> int:
    """The version of a writer's batch; a writer seen for the first time gets the next number.

    Without a writer, for a caller that counts its batches itself, the batch's own number.
    """
    if writer is None:
        return batch
    if batch >= _BATCHES:
        raise ValueError(f"batch {batch} is beyond {_BATCHES}")
    hadoop, folder, files = hadoop_folder(spark, f"{path.rstrip('/')}/_writers")
    names = [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
    known = {name.split("=", 1)[1]: int(name.split("=", 1)[0]) for name in names}
    if writer not in known:
        known[writer] = max(known.values(), default=-1) + 1
        files.mkdirs(hadoop.Path(folder, f"{known[writer]}={writer}"))
    return known[writer] * _BATCHES + batch


def _delete(spark: SparkSession, name: str) -> None:
    _, path, files = hadoop_folder(spark, name)
    files.delete(path, True)


def _finished(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the complete `name=<number>` folders."""
    hadoop, path, files = hadoop_folder(spark, folder)
    if not files.exists(path):
        return []
    found = [status.getPath() for status in files.listStatus(path) if status.isDirectory()]
    return sorted(
        int(p.getName().split("=")[1])
        for p in found
        if p.getName().startswith(f"{name}=") and files.exists(hadoop.Path(p, "_SUCCESS"))
    )


def _numbers(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the `name=<number>` folders, complete or not."""
    _, path, files = hadoop_folder(spark, folder)
    names = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()] if files.exists(path) else []
    return sorted(int(n.split("=")[1]) for n in names if n.startswith(f"{name}="))


class KeyedTable:
    """Rows by key.

    With `merges` ({column: sum | min | max}) each batch holds deltas that are merged.
    Otherwise the newest row of a key replaces the others: the one with the greatest
    `sequence` columns if there are any, else the one of the last batch, in which case a
    batch must have one row per key. Then `deleted`, a condition in SQL, marks rows that stand
    for the removal of their key; they are kept, so that an older change that comes late does
    not bring the key back, and left out by `rows`.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        merges: dict[str, str] | None = None,
        sequence: Sequence[str] = (),
        deleted: str | None = None,
        buckets: int | None = None,
    ):
        if merges is not None and deleted is not None:
            raise ValueError("a table of merged deltas has no deletes")
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)
        self.merges, self.sequence, self.deleted = merges, list(sequence), deleted
        self.wanted_buckets = buckets or BUCKETS

    @property
    def buckets(self) -> int:
        """The number of buckets that the table was made with, or will be."""
        found = _numbers(self.spark, f"{self.path}/_buckets", "n")
        return found[0] if found else self.wanted_buckets

    def _bucket(self, buckets: int) -> Column:
        # keys as text, so that the width of a number does not matter
        return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(buckets)).cast("int")

    def buckets_of(self, rows: DataFrame) -> list[int]:
        """The buckets that rows with the table's keys belong to."""
        return sorted(r[0] for r in rows.select(self._bucket(self.buckets).alias(_BUCKET)).distinct().collect())

    def _write(self, rows: DataFrame, folder: str) -> None:
        buckets = self.buckets
        if not _numbers(self.spark, f"{self.path}/_buckets", "n"):
            # rows without any file of their own still have a schema
            rows.limit(0).write.mode("overwrite").parquet(f"{self.path}/_schema")
            hadoop, path, files = hadoop_folder(self.spark, f"{self.path}/_buckets/n={buckets}")
            files.mkdirs(path)
        numbered = rows.withColumn(_BUCKET, self._bucket(buckets)).hint("rebalance", _BUCKET)
        numbered.write.mode("overwrite").partitionBy(_BUCKET).parquet(folder)

    def _merged(self, df: DataFrame, order: Sequence[str]) -> DataFrame:
        if self.merges is None:
            return latest_per_key(df, self.keys, order)
        return df.groupBy(*self.keys).agg(*[_MERGES[how](c).alias(c) for c, how in self.merges.items()])

    def upsert(self, rows: DataFrame, batch: int, writer: str | None = None) -> int:
        """Apply one batch, or apply it again; its version."""
        if self.merges is not None or self.sequence:
            rows = self._merged(rows, self.sequence)
        version = version_of(self.spark, self.path, writer, batch)
        self._write(rows, f"{self.path}/batches/batch={version}")
        return version

    def rows(self) -> DataFrame | None:
        """The table without the keys that were removed."""
        found = self.read()
        if found is None or self.deleted is None:
            return found
        return found.filter(~F.coalesce(F.expr(self.deleted), F.lit(False)))

    def read(self, before: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame | None:
        """The table as the batches (those with a number less than `before`) left it; with `buckets`, these only."""

        def wanted(numbers):
            return [n for n in numbers if before is None or n < before]

        bases = wanted(_finished(self.spark, f"{self.path}/bases", "upto"))
        base = bases[-1] if bases else -1
        batches = [n for n in wanted(_finished(self.spark, f"{self.path}/batches", "batch")) if n > base]
        if not bases and not batches:
            return None
        newest = self._newest(bases)
        parts = [f"{self.path}/bases/upto={n}/{_BUCKET}={b}" for b, n in newest.items() if buckets is None or b in buckets]
        rows = self._load("bases", "upto", parts)
        parts = [
            f"{self.path}/batches/batch={n}/{_BUCKET}={b}"
            for n in batches
            for b in _numbers(self.spark, f"{self.path}/batches/batch={n}", _BUCKET)
            if buckets is None or b in buckets
        ]
        if bases or len(batches) > 1:
            rows = rows.unionByName(self._load("batches", "batch", parts))
        else:
            return self._alone(self._load("batches", "batch", parts))
        if not batches:
            return self._alone(rows)
        merged = self._merged(rows, [*self.sequence, _VERSION])
        return merged.drop(_VERSION) if self.merges is None else merged

    def _alone(self, rows: DataFrame) -> DataFrame:
        """What one base or one batch holds, which has no key twice."""
        return rows.drop(_VERSION)

    def _newest(self, bases: Sequence[int]) -> dict[int, int]:
        """For each bucket the last of the bases that holds it."""
        return {b: n for n in sorted(bases) for b in _numbers(self.spark, f"{self.path}/bases/upto={n}", _BUCKET)}

    def _load(self, kind: str, name: str, paths: list[str]) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.path}/_schema").schema
        if not paths:
            return self.spark.createDataFrame([], schema.add(_VERSION, T.LongType()))
        reader = self.spark.read.option("basePath", f"{self.path}/{kind}")
        rows = reader.schema(schema.add(name, T.LongType()).add(_BUCKET, T.IntegerType())).parquet(*paths)
        return rows.withColumnRenamed(name, _VERSION).drop(_BUCKET)

    def compact(self, before: int | None = None) -> None:
        """Merge all complete batches, or those `before` a version, into the base that later reads start from.

        Only the buckets that these batches touch are rewritten. Of each bucket the form before stays, as do the
        batches since then; older ones are deleted.
        """
        bases = _finished(self.spark, f"{self.path}/bases", "upto")
        batches = _finished(self.spark, f"{self.path}/batches", "batch")
        batches = [n for n in batches if before is None or n < before]
        last = bases[-1] if bases else -1
        if not batches or batches[-1] <= last:
            return
        touched = {
            b for n in batches if n > last for b in _numbers(self.spark, f"{self.path}/batches/batch={n}", _BUCKET)
        }
        self._write(self.read(before, sorted(touched)), f"{self.path}/bases/upto={batches[-1]}")
        kept = self._newest(bases)
        for number in bases[:-1]:
            held = _numbers(self.spark, f"{self.path}/bases/upto={number}", _BUCKET)
            gone = [b for b in held if kept[b] != number]
            if len(gone) == len(held):
                _delete(self.spark, f"{self.path}/bases/upto={number}")
            else:
                for b in gone:
                    _delete(self.spark, f"{self.path}/bases/upto={number}/{_BUCKET}={b}")
        for number in batches:
            if number <= last:
                _delete(self.spark, f"{self.path}/batches/batch={number}")

    def open_batches(self) -> int:
        """Batches that a read merges with the base."""
        bases = _finished(self.spark, f"{self.path}/bases", "upto")
        batches = _finished(self.spark, f"{self.path}/batches", "batch")
        return sum(not bases or n > bases[-1] for n in batches)
