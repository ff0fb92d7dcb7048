"""Starting streams: file sinks, keyed upserts, snapshots, several sinks, ordered aggregates.

Every query gets a checkpoint folder. After a failure Spark repeats the unfinished
micro-batch under the same number; all sinks here replace what that number wrote. A query
with a new checkpoint counts from 0 again, but it is another writer, and what it writes
comes beside what is there.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tidelog.operators.ordered import HOT_KEY_ROWS, Aggregates, running
from tidelog.operators.validate import EDGE_LOG_RULES, REASON, FieldRule, check_records
from tidelog.operators.windows import END_OF_INPUT
from tidelog.session import configure
from tidelog.sinks.derived import DerivedTable
from tidelog.sinks.keyed import KeyedTable, hadoop_folder, version_of

# micro-batches between two compactions of a keyed table
COMPACT_EVERY = 10


def _writer(
    df: DataFrame, checkpoint: str, mode: str, every: str | None, name: str | None
) -> DataStreamWriter:
    """`every` is the time between micro-batches; without it the stream ends when its input is read."""
    configure(df.sparkSession)
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def _writer_of(batch: DataFrame) -> str | None:
    """The id of the streaming query that a micro-batch belongs to."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def to_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    format: str = "parquet",
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append rows to files: closed windows, or a stream without aggregates."""
    return _writer(df, checkpoint, "append", every, name).format(format).start(path)


def to_console(df: DataFrame, checkpoint: str, mode: str = "append", every: str | None = None):
    return _writer(df, checkpoint, mode, every, None).format("console").start()


def to_batches(
    df: DataFrame,
    function: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    return _writer(df, checkpoint, mode, every, name).foreachBatch(function).start()


def upsert(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    checkpoint: str,
    merges: dict[str, str] | None = None,
    sequence: Sequence[str] = (),
    mode: str = "update",
    every: str | None = None,
    name: str | None = None,
    deleted: str | None = None,
    compact_every: int = COMPACT_EVERY,
    buckets: int | None = None,
) -> StreamingQuery:
    """Keep a `KeyedTable` at `path` up to date.

    Running aggregates in update mode replace their rows. With `merges` the batches must
    hold deltas: feed the raw rows in append mode, not a running count. After every
    `compact_every` open batches the table is compacted, so a read merges no more than those.
    """

    def apply(batch: DataFrame, number: int) -> None:
        table = KeyedTable(batch.sparkSession, path, keys, merges, sequence, deleted, buckets)
        table.upsert(batch, number, _writer_of(batch))
        if table.open_batches() >= compact_every:
            table.compact()

    return to_batches(df, apply, checkpoint, mode, every, name)


def derive(
    changes: DataFrame,
    path: str,
    keys: Sequence[str],
    sequence: Sequence[str],
    children: Callable[[DataFrame], DataFrame],
    checkpoint: str,
    deleted: str = "op = 'D'",
    every: str | None = None,
    name: str | None = None,
    buckets: int | None = None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Keep a `DerivedTable` at `path` up to date with a feed of changes of its parents."""

    def apply(batch: DataFrame, number: int) -> None:
        table = DerivedTable(batch.sparkSession, path, keys, sequence, deleted, buckets)
        batch.persist()
        try:
            table.apply(batch, children, number, _writer_of(batch))
        finally:
            batch.unpersist()
        if table.open_batches() >= compact_every:
            table.compact()

    return to_batches(changes, apply, checkpoint, "append", every, name)


def upsert_several(
    df: DataFrame,
    tables: dict[str, tuple[Callable[[DataFrame], DataFrame], dict]],
    checkpoint: str,
    every: str | None = None,
    name: str | None = None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Keep several `KeyedTable`s up to date from one reading of a stream.

    `tables` has for each path a function from a micro-batch to the table's rows, and the
    table's other arguments (keys, merges, sequence, deleted).
    """

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        try:
            for path, (branch, options) in tables.items():
                table = KeyedTable(spark, path, **options)
                table.upsert(branch(batch), number, _writer_of(batch))
                if table.open_batches() >= compact_every:
                    table.compact()
        finally:
            batch.unpersist()

    return to_batches(df, apply, checkpoint, "append", every, name)


def run_bounded(start: Callable[[], StreamingQuery], ended: str, spark: SparkSession) -> None:
    """Run a stream over all there is, then once more so that nothing stays open.

    `start` starts the query from its checkpoint; its frame was made by `windows.watermarked` with the same
    folder `ended`, which is this query's own: another one would read its end before its input. After that the input has ended: rows that come later are late. A run that failed
    is repeated by calling this again.
    """
    start().awaitTermination()
    _, folder, files = hadoop_folder(spark, ended)
    if not files.exists(folder) or not files.listStatus(folder):
        rows = spark.range(1).select(F.lit(END_OF_INPUT).cast("timestamp").alias("at"))
        rows.coalesce(1).write.mode("overwrite").parquet(ended)
    start().awaitTermination()


def run_until_idle(query: StreamingQuery, poll_seconds: float = 0.3) -> None:
    """Stop a stream once micro-batches find no new rows.

    For streams whose state expires by the clock: they go on with empty micro-batches
    when their input is used up.
    """
    try:
        while not query.awaitTermination(poll_seconds):
            # a first empty micro-batch may be one that the last run left unfinished
            last = [progress["numInputRows"] for progress in query.recentProgress[-2:]]
            if last == [0, 0]:
                return
    finally:
        query.stop()


def snapshots(
    aggregate: DataFrame, path: str, checkpoint: str, every: str | None = None, name: str | None = None
) -> StreamingQuery:
    """After each micro-batch append the whole aggregate, marked with `snapshot_id`."""

    def append(batch: DataFrame, number: int) -> None:
        version = version_of(batch.sparkSession, path, _writer_of(batch), number)
        batch.write.mode("overwrite").parquet(f"{path}/snapshot_id={version}")

    return to_batches(aggregate, append, checkpoint, "complete", every, name)


def fan_out(
    df: DataFrame,
    branches: dict[str, Callable[[DataFrame], DataFrame]],
    checkpoint: str,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Write several results of each micro-batch, each below its own folder."""

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            for path, branch in branches.items():
                version = version_of(batch.sparkSession, path, _writer_of(batch), number)
                branch(batch).write.mode("overwrite").parquet(f"{path}/batch={version}")
        finally:
            batch.unpersist()

    return to_batches(df, write, checkpoint, "append", every, name)


def validated(
    records: DataFrame,
    path: str,
    counts: str,
    checkpoint: str,
    column: str = "value",
    rules: tuple[FieldRule, ...] = EDGE_LOG_RULES,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Append the records that keep the rules to `path`, and for each micro-batch how many each reason stopped.

    `counts` gets (reason, records, batch), good records under `ok`, so rejected ones are never dropped unseen. A
    repeated micro-batch replaces its numbers.
    """
    branches = {
        path: lambda batch: batch.filter(F.col(REASON).isNull()).drop(REASON),
        counts: lambda batch: batch.groupBy(F.coalesce(REASON, F.lit("ok")).alias("reason")).agg(
            F.count("*").alias("records")
        ),
    }
    return fan_out(check_records(records, column, rules), branches, checkpoint, every, name)


def running_batches(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    aggregates: Aggregates,
    path: str,
    checkpoint: str,
    finish: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    previous: bool = False,
    max_rows_per_task: int = HOT_KEY_ROWS,
    every: str | None = None,
    name: str | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """`ordered.running` over a stream: each row with its key's aggregates so far.

    The totals of earlier micro-batches lie in a `KeyedTable` beside the checkpoint. They
    join a batch as one leading row per key, so a hot key is cut like any batch. Of the table a
    micro-batch opens the buckets of its own keys only. Rows are
    in order inside a micro-batch, and micro-batches follow each other.
    """
    keys, order = list(keys), list(order)
    merges = {n: "sum" if kind == "count" else kind for n, (kind, _) in aggregates.items()}

    def partial(kind: str, column):
        value = F.col(column) if isinstance(column, str) else column
        return F.when(value.isNotNull(), F.lit(1).cast("bigint")) if kind == "count" else value

    def step(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            write(batch, number)
        finally:
            batch.unpersist()

    def write(batch: DataFrame, micro_batch: int) -> None:
        spark = batch.sparkSession
        state = KeyedTable(spark, f"{checkpoint}-totals", keys, merges, buckets=buckets)
        number = version_of(spark, f"{checkpoint}-totals", _writer_of(batch), micro_batch)
        new = batch.withColumns(
            {f"_part_{n}": partial(kind, column) for n, (kind, column) in aggregates.items()}
        ).withColumn("_kind", F.lit(1))
        # only the buckets that the batch's keys lie in
        earlier = state.read(before=number, buckets=state.buckets_of(batch))
        rows = new
        if earlier is not None:
            present = batch.select(*[F.col(k).alias(f"_on_{k}") for k in keys]).distinct()
            same_key = reduce(
                lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_on_{k}")) for k in keys]
            )
            asked = earlier.join(present, same_key, "left_semi")
            leading = asked.withColumnsRenamed({n: f"_part_{n}" for n in aggregates})
            leading = leading.withColumn("_kind", F.lit(0))
            rows = new.unionByName(leading, allowMissingColumns=True)
        parts = {n: (how, f"_part_{n}") for n, how in merges.items()}
        out = running(rows, keys, ["_kind", *order], parts, previous, max_rows_per_task)
        out = out.filter("_kind = 1").drop("_kind", *[f"_part_{n}" for n in aggregates])
        finish(out).write.mode("overwrite").parquet(f"{path}/batch={number}")
        totals = new.select(*keys, *[F.col(f"_part_{n}").alias(n) for n in aggregates])
        state.upsert(totals, number)
        # a replay reads what was there before its own number, so a base must not reach it yet
        if micro_batch % COMPACT_EVERY == 0:
            state.compact(before=number)

    return to_batches(df, step, checkpoint, "append", every, name)
