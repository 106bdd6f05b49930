"""Chapters as soon as they are complete: pages come in any order and in any files, and a chapter is given out once all of them are there.

State by chapter (a processor of arbitrary state): the pages that have come, until the last one; then only that the chapter is done. Pages that come
after that are reported as late, and a chapter that waits longer than it may is given out as far as it is, by a timer. A chapter's pages are what its
state holds: bounded by what a chapter is.

Edge cases: a page that comes twice counts once, as it came first; a null text is an empty page; a page without a chapter, number or number of pages
is dropped; pages numbered beyond the number of pages count like others; other columns are not read. No pages give no chapters.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUT = "chapter string, state string, n_pages int, text string"


class Chapters(StatefulProcessor):
    def __init__(self, patience_ms: int, joint: str) -> None:
        self.patience_ms, self.joint = patience_ms, joint

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pages = handle.getMapState("pages", "page int", "text string")
        self.done = handle.getValueState("done", "n int")

    def _given(self, key: tuple, state: str) -> Row:
        pages = sorted((k[0], v[0]) for k, v in self.pages.iterator())
        self.pages.clear()
        self.done.update((len(pages),))
        return Row(chapter=key[0], state=state, n_pages=len(pages), text=self.joint.join(t for _, t in pages))

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        fresh = not self.done.exists() and not self.pages.exists()
        wanted = 0
        for r in rows:
            wanted = max(wanted, r.wanted)
            if self.done.exists():
                yield Row(chapter=key[0], state="late", n_pages=1, text=r.text or "")
            elif not self.pages.containsKey((r.page,)):
                self.pages.updateValue((r.page,), (r.text or "",))
                if sum(1 for _ in self.pages.keys()) >= wanted:
                    yield self._given(key, "complete")
        if fresh and self.patience_ms and not self.done.exists():
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience_ms)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.done.exists() and self.pages.exists():
            yield self._given(key, "incomplete")

    def close(self) -> None:
        pass


def complete_chapters(pages: DataFrame, chapter: str, page: str, wanted: str, text: str, patience_ms: int = 0, joint: str = "\n\n") -> DataFrame:
    """(chapter, state, n_pages, text) of a stream of pages: complete chapters with their pages in order, late pages, and with `patience_ms` chapters that
    waited in vain. The session's state store must be RocksDB when the query starts (`run`)."""
    rows = pages.select(F.col(chapter).cast("string").alias("chapter"), F.col(page).cast("int").alias("page"), F.col(wanted).cast("int").alias("wanted"), F.col(text).alias("text")).dropna(subset=["chapter", "page", "wanted"])
    return rows.groupBy("chapter").transformWithState(Chapters(patience_ms, joint), OUT, "Append", "ProcessingTime" if patience_ms else "None")


def run(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Runs over what there is now, and appends to target; a failed run is repeated from its checkpoint without loss or repeats."""
    conf = stream.sparkSession.conf
    before = conf.get(PROVIDER, None)
    conf.set(PROVIDER, ROCKS)
    try:
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", target).trigger(availableNow=True).start().awaitTermination()
    finally:
        conf.set(PROVIDER, before) if before else conf.unset(PROVIDER)
