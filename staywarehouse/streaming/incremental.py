"""Fact loads fed by a staging directory.

Every micro-batch goes through the same load as a batch run. Its commit names the stream and the
number of the micro-batch, so one that runs again is known before any work and leaves fact, rejects
and log as they are. Copies of a key are settled alike whether they come in one micro-batch or in
several: the first to arrive (by time of the file, path and place in it) is loaded. A micro-batch
is cleaned, typed and written once, and removed when its load is done. Failures of a load go to the
error log, and so does what ends a stream outside of loads, such as a file that cannot be read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..functions.dates import moment
from ..operators.facts import ARRIVAL, FACTS
from ..plans.full_load import Run
from ..schemas import STAGING_KEYS, nullable, schema, typed
from ..session import discard, kept_once
from ..sources import staging


class Failures(StreamingQueryListener):
    """Writes an error row for a stream that ends with an error which no load has logged."""

    def __init__(self, run: Run, name: str, procedure: str):
        self.run, self.name, self.procedure = run, name, procedure
        self.id, self.logged = None, False

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.id = str(event.id)

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.id and event.exception and not self.logged:
            self.logged = True
            self.run.log_error(self.procedure, RuntimeError(event.exception))


def stream_fact(run: Run, table: str, folder: str, checkpoint: str,
                files_per_batch: int = 1000) -> StreamingQuery:
    """Load what arrived in ``folder`` since the last call, then stop."""
    fact, spark = FACTS[table], run.store.spark
    name = f"stream_{table}_{uuid.uuid4().hex}"
    failures = Failures(run, name, f"stream_{table}")
    arriving = (spark.readStream.schema(nullable(schema(fact.staging)))
                .option("maxFilesPerTrigger", files_per_batch).parquet(folder)
                .withColumn(ARRIVAL, F.struct("_metadata.file_modification_time",
                                              "_metadata.file_path", "_metadata.row_index")))

    def load(rows: DataFrame, number: int) -> None:
        try:
            load_batch(run, table, rows, f"{failures.id}:{number}")
        except Exception:
            failures.logged = True
            raise

    spark.streams.addListener(failures)
    return (arriving.writeStream.queryName(name).foreachBatch(load)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def load_batch(run: Run, table: str, rows: DataFrame, source: str) -> dict:
    """Load one micro-batch, known by ``source``, unless it is already loaded."""
    fact = FACTS[table]
    if (done := run.replayed(table, source)) is not None:
        return done
    with run.errors_logged(f"stream_{table}"):
        ready = staging.clean(rows, STAGING_KEYS[fact.staging])
        columns = typed(ready, fact.staging, {"loaded_at": moment(run.clock())})
        kept, path = kept_once(ready.select(*columns, ARRIVAL), f"stream-{table}")
    done = run.load_fact(table, staged=kept, source=source)
    discard(run.store.spark, path)
    return done
