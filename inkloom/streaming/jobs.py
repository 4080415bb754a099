"""Continuous jobs: normalize arrivals, drop repeats, keep a library current."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from inkloom.operators.fetches import TTL_MS, latest_captures
from inkloom.plans.chapters import fetched_chapters
from inkloom.session import scratch_path
from inkloom.sources.library import publish


def read_stream(
    spark: SparkSession, path: str, schema: StructType | str, name_filter: str | None = None, files_per_batch: int = 1000
) -> DataFrame:
    """Arriving parquet files as a stream."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.parquet(path)


def _run(writer, every: str | None) -> StreamingQuery:
    """Start a job: over everything that has arrived, until that is done, or on and on at an interval."""
    if every is not None:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stream_captures(
    captures: DataFrame, out: str, checkpoint: str, base: str, allow_unavailable: bool = False, every: str | None = None
) -> StreamingQuery:
    """Normalize arriving chapter captures; failures become rows.  ``every`` (as "1 minute") keeps it running."""
    rows = fetched_chapters(captures, base, allow_unavailable)
    return _run(_to_files(rows, out, checkpoint), every)


# ------------------------------------------------------------------- dedupe

_DEDUPE_OUT = "url string, kind string, fetched_at timestamp, capture_id string"
BUCKETS = 512  # of addresses, for each kind; a checkpoint holds on to the number
_NO_TIME = np.iinfo(np.int64).min  # stands for a null time
_ENTRY = pa.schema([("url", pa.string()), ("at", pa.int64()), ("since", pa.int64())])


def _near(code: np.ndarray, at: np.ndarray, kept_code: np.ndarray, kept_at: np.ndarray, period: int) -> np.ndarray:
    """Which captures lie less than a period before or after a kept one of their address."""
    near, n = np.zeros(len(at), bool), len(at) + len(kept_at)
    if not len(kept_at):
        return near
    codes, times = np.concatenate([code, kept_code]), np.concatenate([at, kept_at])
    order = np.lexsort((times, codes))
    codes, times, is_kept = codes[order], times[order], order >= len(at)
    place = np.arange(n)
    before = np.maximum.accumulate(np.where(is_kept, place, -1))
    after = np.minimum.accumulate(np.where(is_kept, place, n)[::-1])[::-1]
    found = np.zeros(n, bool)
    for other in (before, after):
        there = np.clip(other, 0, n - 1)
        found |= (other == there) & (codes[there] == codes) & (np.abs(times - times[there]) < period)
    near[order[~is_kept]] = found[~is_kept]
    return near


class FirstPerPeriod(StatefulProcessor):
    """Keeps of each address the first capture per period; a group is one kind's addresses of a bucket.

    Kept times of an address are a period apart at least, so a stretch of time
    as long as one period holds one of them at most.  The state of a group is a
    map from stretch to the addresses and times kept there; a capture is looked
    up in its own stretch and the two beside it.  Each stretch is read and
    written once a batch, whatever the number of addresses; stretches that a
    batch does not touch are not read.
    """

    def __init__(self, ttl_us: Mapping[str, int], state_ms: int | None):
        self.ttl_us, self.state_ms = dict(ttl_us), state_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getMapState("kept", "stretch long", "entries binary", self.state_ms)

    def _load(self, stretches: np.ndarray, seen: dict[int, pa.Table | None], now: int) -> list[pa.Table]:
        """What was kept in the stretches and in those beside them and is not forgotten."""
        around = np.unique(np.concatenate([stretches - 1, stretches, stretches + 1])).tolist()
        for stretch in around:
            if stretch not in seen:
                found = self.kept.getValue((stretch,))
                table = None if found is None else pa.ipc.open_stream(found[0]).read_all()
                if table is not None and self.state_ms is not None:
                    table = table.filter(pc.greater(table["since"], now - self.state_ms))
                seen[stretch] = table
        return [seen[s] for s in around if seen.get(s) is not None]

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        _, kind = key
        period = self.ttl_us.get(kind, 0)
        named = lambda url, at, ids: pd.DataFrame({"url": url, "kind": kind, "fetched_at": pd.to_datetime(at, unit="us"), "capture_id": ids})
        times_of = lambda frame: frame["fetched_us"].fillna(_NO_TIME).to_numpy(np.int64)
        if period <= 0:  # every capture counts
            for frame in rows:
                yield named(frame["url"].to_numpy(object), times_of(frame), frame["capture_id"].to_numpy(object))
            return
        now = 0 if self.state_ms is None else timerValues.getCurrentProcessingTimeInMs()
        seen: dict[int, pa.Table | None] = {} if self.kept.exists() else _Nothing()
        urls, times, ids = [], [], []
        for frame in rows:
            url, at = frame["url"].to_numpy(object), times_of(frame)
            new = np.ones(len(at), bool)
            known = self._load(np.unique(at // period), seen, now)
            if known:
                known = pa.concat_tables(known)
                code, _ = pd.factorize(np.concatenate([url, known["url"].to_numpy()]))
                new = ~_near(code[: len(at)], at, code[len(at) :], known["at"].to_numpy(), period)
            urls.append(url[new])
            times.append(at[new])
            ids.append(frame["capture_id"].to_numpy(object)[new])
        url, at, capture = np.concatenate(urls), np.concatenate(times), np.concatenate(ids)
        if not len(at):
            return
        code, _ = pd.factorize(url)
        order = np.lexsort((at, code))
        url, at, capture, code = url[order], at[order], capture[order], code[order]
        first, own, until = [], None, 0
        for place, (address, moment) in enumerate(zip(code.tolist(), at.tolist(), strict=True)):
            if address != own or moment >= until:
                first.append(place)
                own, until = address, moment + period
        # of captures at one time the least id counts
        changes = np.flatnonzero((code[1:] != code[:-1]) | (at[1:] != at[:-1])) + 1
        ends = np.append(changes, len(at))[np.searchsorted(changes, first, "right")].tolist()
        picked = np.array([p if end == p + 1 else p + int(np.argmin(capture[p:end].astype(str))) for p, end in zip(first, ends, strict=True)])
        url, at, capture = url[picked], at[picked], capture[picked]
        stretch = at // period
        order = np.argsort(stretch, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(stretch[order])) + 1):
            table = pa.table([pa.array(url[part], pa.string(), from_pandas=True), pa.array(at[part]), pa.array(np.full(len(part), now))], schema=_ENTRY)
            before = seen.get(number := int(stretch[part[0]]))
            table = table if before is None else pa.concat_tables([before, table])
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _ENTRY) as writer:
                writer.write_table(table.combine_chunks())
            self.kept.updateValue((number,), (sink.getvalue().to_pybytes(),))
        yield named(url, at, capture)

    def close(self) -> None:
        pass


class _Nothing(dict):
    """What a group without state knows of its stretches."""

    def __contains__(self, stretch: object) -> bool:
        return True


def dedupe_stream(captures: DataFrame, ttl_ms: Mapping[str, int] = TTL_MS, state_ms: int | None = None) -> DataFrame:
    """First capture of each key per freshness period, over the whole stream.

    A capture less than a period before or after a kept one is a repeat; every
    other is kept, also one that arrives late or out of order, however late.
    There is no watermark, which would discard late rows.  A kept time is
    forgotten ``state_ms`` of running time after it was kept, if given, so what
    expires can only let a repeat through.  Only addresses, times and ids reach
    Python, never bodies; repeats of kept times are dropped frame by frame, so a
    task holds the new captures of one kind and bucket of addresses in a batch.
    """
    bucket = F.pmod(F.xxhash64("url"), F.lit(BUCKETS)).alias("bucket")
    keyed = captures.select(bucket, "url", "kind", "capture_id", F.unix_micros("fetched_at").alias("fetched_us"))
    processor = FirstPerPeriod({kind: ms * 1000 for kind, ms in ttl_ms.items()}, state_ms)
    mode = "none" if state_ms is None else "processingTime"
    return keyed.groupBy("bucket", "kind").transformWithStateInPandas(processor, _DEDUPE_OUT, "append", mode)


def stream_dedupe(
    captures: DataFrame,
    out: str,
    checkpoint: str,
    ttl_ms: Mapping[str, int] = TTL_MS,
    state_ms: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    spark, rows = captures.sparkSession, dedupe_stream(captures, ttl_ms, state_ms)
    # state that expires by the clock asks for batches without data for ever; a run over what has arrived has an end
    name = "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false" if every is None else before)
    try:
        return _run(_to_files(rows, out, checkpoint), every)
    finally:
        spark.conf.set(name, before)


def _to_files(rows: DataFrame, out: str, checkpoint: str):
    return rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)


# ------------------------------------------------------------------ library


def _add_batch(base: str, library: str, stream: str) -> Callable[[DataFrame, int], None]:
    def add(batch: DataFrame, batch_id: int) -> None:
        rows = fetched_chapters(latest_captures(batch, ("book_slug", "chapter_slug")), base)
        publish(batch.sparkSession, library, {"chapters": rows}, version=f"{stream}-{batch_id}")

    return add


def stream_library(captures: DataFrame, library: str, checkpoint: str, base: str, every: str | None = None) -> StreamingQuery:
    """Keep the newest chapter of each key current: ``read_chapters`` gives it, ``download_summary`` its counts.

    Each batch adds a version of its own chapters and rewrites nothing; the
    newest capture of a chapter is found by the reader.  A replayed batch writes
    the same version again.  ``compact_library`` bounds what a reader goes
    through and may run beside the stream.
    """
    stream = f"batch-{zlib.crc32(checkpoint.encode()):08x}"
    writer = captures.writeStream.foreachBatch(_add_batch(base, library, stream))
    return _run(writer.option("checkpointLocation", checkpoint), every)


def new_run(spark: SparkSession, name: str) -> tuple[str, str]:
    """Fresh output and checkpoint folders for one run."""
    root = scratch_path(spark, name)
    return f"{root}/out", f"{root}/checkpoint"
