"""Starting a feed's stream."""

from __future__ import annotations

import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def start(
    feed: DataFrame,
    apply: Callable[[DataFrame, int], None],
    checkpoint: str,
    poll_seconds: float | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Follow the feed at a fixed cadence, or take what is there and stop (no ``poll_seconds``).

    The checkpoint advances only after ``apply`` returned, so a crash repeats a batch; the
    folder of its own that a batch writes to makes the repetition harmless.
    """
    writer = feed.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if poll_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{poll_seconds} seconds").start()


def drain(feed: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process everything available and return when it is done."""
    start(feed, apply, checkpoint).awaitTermination()


def catch_up(query: StreamingQuery) -> None:
    """Let a polling stream take micro-batches until it finds nothing new, then stop it.

    For sources that decide themselves how much a micro-batch takes: the end of such a stream is found by
    asking again, not known beforehand.
    """
    try:
        query.processAllAvailable()
    finally:
        query.stop()


class Finished(Exception):
    """A micro-batch after the last one of a run; the next run takes it."""


def poll_until(
    feed: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str, field: str, reached: int, poll_seconds: float
) -> None:
    """Poll the feed until a micro-batch holds a row whose ``field`` is at least ``reached``; that one is applied whole.

    This is what bounds a run to what had changed when it began: the feed goes on, the run does not.  The
    highest value is observed while the micro-batch is written, without reading it once more.  A feed that
    has nothing as late is polled on.
    """
    done = threading.Event()

    def watched(batch: DataFrame, batch_id: int) -> None:
        if done.is_set():
            raise Finished
        top = Observation()
        apply(batch.observe(top, F.max(field).alias("top")), batch_id)
        if (top.get["top"] or 0) >= reached:
            done.set()

    query = start(feed, watched, checkpoint, poll_seconds)
    while query.isActive and not done.wait(0.05):
        pass
    query.stop()
    if query.exception() and not done.is_set():
        raise query.exception()


def repeat(job: Callable[[], object], seconds: float, stop: threading.Event) -> None:
    """Run a batch job at a fixed cadence until told to stop; a long run shortens the wait."""
    while not stop.is_set():
        started = time.monotonic()
        job()
        stop.wait(max(seconds - (time.monotonic() - started), 0))
