"""Ingestion of landed response files as they arrive.

The stream's checkpoint decides what is new; a high-water mark that a batch run has set is a floor that the stream never moves
back. Each micro-batch is landed in a commit of its own before it is mapped, so its raw items are kept whatever they
are. Both commits record the batch number, so a batch that is run again after a failure is recognised and changes
nothing twice. A batch that cannot be mapped is written to the run log as failed, and the next ones load.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tallyweave.plans.entities import EntitySpec
from tallyweave.plans.ingest import FAILED, SUCCESS, EntityResult, LoadOptions, land, load_items, staging_table, write_run_log
from tallyweave.sources.versioned import StoreConflict, VersionedStore

log = logging.getLogger(__name__)


def landed_pages(spark, folder: str, *, files_per_batch: int = 10_000) -> DataFrame:
    """One response per line of the landed text files, ordered by arrival."""
    return (
        spark.readStream.format("text").option("maxFilesPerTrigger", files_per_batch).load(folder)
        .select(
            F.col("value").alias("body"),
            F.concat_ws(" ", F.col("_metadata.file_modification_time").cast("string"), "_metadata.file_path").alias("landed"),
        )
    )


def apply_batch(store: VersionedStore, spec: EntitySpec, pages: DataFrame, batch_id: int,
                options: LoadOptions, endpoint: str | None = None) -> bool:
    """Load one micro-batch; False when it is already in the store."""
    started = dt.datetime.now(dt.timezone.utc)
    manifest = store.manifest()
    if manifest.batches.get(spec.name, -1) >= batch_id:
        return False
    table = staging_table(spec.name)
    if manifest.landed.get(spec.name, {}).get("batch", -1) < batch_id:
        with store.commit() as landing:
            pulled, rejected = land(landing, spec, pages, endpoint or spec.name, options)
            landing.set_landed(spec.name, table, batch_id, {"pulled": pulled, "rejected": rejected})
        manifest = store.manifest()
    entry = manifest.landed[spec.name]
    counts = (entry["pulled"], entry["rejected"])
    try:
        with store.commit() as change:
            floor = store.manifest().marks.get(spec.name, {}).get("value")
            upserted = load_items(change, spec, store.landed(spec.name), None, options, floor and dt.datetime.fromisoformat(floor))
            change.set_batch(spec.name, batch_id)
        result = EntityResult(spec.name, SUCCESS, counts[0], upserted, responses_rejected=counts[1])
    except StoreConflict:
        raise
    except Exception as error:
        log.exception("batch %d of %s failed; its items stay in %s", batch_id, spec.name, table)
        with store.commit() as change:
            change.set_batch(spec.name, batch_id)
        result = EntityResult(spec.name, FAILED, counts[0], 0, str(error), counts[1])
    write_run_log(store, (result, started, dt.datetime.now(dt.timezone.utc)))
    return True


def ingest_stream(store: VersionedStore, spec: EntitySpec, folder: str, checkpoint: str, *,
                  options: LoadOptions = LoadOptions(on_duplicate="last"), endpoint: str | None = None,
                  files_per_batch: int = 10_000) -> StreamingQuery:
    """Process everything that has arrived in ``folder`` and stop; start it again for what comes later.

    An item that arrives twice in a batch is taken from the file that arrived last, and there from the last line and
    place. With ``on_duplicate="error"`` the split into batches (``files_per_batch``) decides whether two copies are an error.
    """
    def load(batch: DataFrame, batch_id: int) -> None:
        apply_batch(store, spec, batch, batch_id, options, endpoint)

    return (
        landed_pages(store.spark, folder, files_per_batch=files_per_batch)
        .writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
