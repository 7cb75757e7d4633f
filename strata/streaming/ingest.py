"""Append-only tables fed by files or tables, each input file once."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence
from threading import Event

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from strata.sources.files import batch_glob, text_schema, with_lineage


def stream_batches(
    spark: SparkSession, root: str, entity: str, columns: Sequence[str], **options: str
) -> DataFrame:
    """The batches of an entity as a stream of text rows with lineage.

    Folders that appear later are picked up by the next run. ``options`` go to the source, for
    instance ``maxFilesPerTrigger``.
    """
    rows = (
        spark.readStream.schema(text_schema(columns))
        .options(header=True, enforceSchema=False, **options)
        .csv(batch_glob(root, entity))
    )
    return with_lineage(rows)


def stream_table(spark: SparkSession, path: str, schema: T.StructType, **options: str) -> DataFrame:
    """The rows appended to a stored table since the last run."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def append_available(stream: DataFrame, path: str, checkpoint: str) -> int:
    """Append what has not been read yet to the table at ``path``, then stop; rows read.

    Rows are added up over all micro-batches as they are reported; a query's own list of
    recent progress is a short tail.
    """
    seen = _RowCount()
    streams = stream.sparkSession.streams
    streams.addListener(seen)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    try:
        query.awaitTermination()
        return seen.of(str(query.runId))
    finally:
        streams.removeListener(seen)


class _RowCount(StreamingQueryListener):
    """Input rows per run and micro-batch."""

    def __init__(self):
        self.rows: dict[str, dict[int, int]] = {}
        self.ended: dict[str, Event] = defaultdict(Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        batches = self.rows.setdefault(str(event.progress.runId), {})
        batches[event.progress.batchId] = event.progress.numInputRows

    def onQueryTerminated(self, event) -> None:
        self.ended[str(event.runId)].set()

    def of(self, run: str) -> int:
        """Rows of a run that has ended; its last report may still be on its way."""
        if not self.ended[run].wait(60):
            raise TimeoutError("the end of a stream was not reported")
        return sum(self.rows.get(run, {}).values())


def load_once(
    spark: SparkSession,
    root: str,
    entity: str,
    columns: Sequence[str],
    path: str,
    checkpoint: str,
    select: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> int:
    """Bulk load that skips files it has loaded before; ``select`` projects while loading."""
    return append_available(select(stream_batches(spark, root, entity, columns)), path, checkpoint)
