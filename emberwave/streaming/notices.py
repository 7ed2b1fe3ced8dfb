"""Messages of a stream, each handed on once: a batch that is replayed after a failure sends nothing twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from emberwave.sources import stores

MESSAGES = "place long, value string"


def send_once(batch: DataFrame, batch_id: int, notify: Callable[[str], None], ledger: str) -> int:
    """Hands the messages (value) of a batch to ``notify``, in order, unless the ledger says that they were; returns how many.

    A batch is written to the ledger as a whole before its first message goes out. So no message goes out twice; those
    of a batch whose sender died between the two stay in the ledger, where they can be seen, and are not sent again. Messages
    are few, and are read back one by one.
    """
    claim = f"{ledger}/batch={batch_id}"
    if stores.size(f"{claim}/_SUCCESS") is not None:
        return 0
    values = batch.where("value IS NOT NULL").select("value")
    ordered = values.orderBy("value").select(F.monotonically_increasing_id().alias("place"), "value")
    ordered.write.mode("overwrite").parquet(claim)
    n = 0
    for row in batch.sparkSession.read.schema(MESSAGES).parquet(claim).orderBy("place").toLocalIterator():
        notify(row.value)
        n += 1
    return n


def start(messages: DataFrame, notify: Callable[[str], None], ledger: str, checkpoint: str) -> StreamingQuery:
    """Sends a stream of messages (value) as it comes, up to what there is now."""
    each = lambda batch, batch_id: send_once(batch, batch_id, notify, ledger)
    return messages.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sent(spark, ledger: str) -> DataFrame:
    """(batch, place, value) of all messages that the ledger has."""
    return spark.read.schema(f"{MESSAGES}, batch long").parquet(ledger).select("batch", "place", "value")
