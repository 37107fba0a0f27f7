"""Merges fed by a stream of JSON lines.

Each micro-batch is parsed, checked and merged like a batch: a key that any day
already has is left out, however late its row comes, so no watermark drops data
and a replayed batch writes nothing.
"""

from __future__ import annotations

import hashlib
import logging
import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..domain import RAW_FIELDS, contract
from ..functions.raw_json import first_violation
from ..operators.quality import row_rules, split
from ..sources.files import exists, remove
from ..sources.raw import flatten
from ..sources.tables import Written, merge

log = logging.getLogger("envlake.treatment")
#: Reasons of lines that never become rows with a station.
NO_RECORD, NOT_FOUND = "line: no record", "codigo_estacao: not registered"


def lines(spark: SparkSession, path: str) -> DataFrame:
    """A stream of (file, value, record) from JSON lines that arrive in a folder; record is null where a line has none or is no JSON."""
    text = spark.readStream.schema("value string").option("recursiveFileLookup", "true").text(path)
    parsed = text.select(F.col("_metadata.file_path").alias("file"), "value", F.try_parse_json("value").alias("v"))
    return parsed.select("file", "value", F.try_variant_get("v", "$.record", "variant").alias("record"))


def stream_name(checkpoint: str) -> str:
    """What a stream's rejected rows are kept under: the same whenever it is started again from its checkpoint."""
    return hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def merge_stream(spark: SparkSession, source: str, dataset: str, folder: str, checkpoint: str, resolve: Callable[[DataFrame], DataFrame | tuple[DataFrame, DataFrame]], report: Callable[[Written], None] | None = None) -> StreamingQuery:
    """Merge what has arrived in source into the dataset's table, then stop (trigger AvailableNow).

    resolve turns flat rows into rows with the contract's columns, as by joining the
    registers of stations; it may return those that it found and those that it did not.
    Lines that are no record, records that break the contract, rows that break a rule
    and rows that are not found are kept with their reasons (see rejected_rows), in a
    folder for each micro-batch that a replay of the batch writes again.
    """
    rules = contract(dataset)

    def batch(rows: DataFrame, number: int) -> None:
        spark, stage = rows.sparkSession, f"{folder.rstrip('/')}/_stage/{uuid.uuid4().hex}"
        try:
            # every line is read and parsed once: all that follows reads columns
            marked = rows.select("file", "value", F.col("record").isNull().alias("_none"), first_violation(F.col("record"), RAW_FIELDS[dataset]).alias("_broken"), "record")
            flatten(marked, dataset).write.parquet(stage)
            flat = spark.read.parquet(stage)
            bad, good = flat.where("not _none and _broken is not null"), flat.where("not _none and _broken is null").drop("_none", "_broken")
            given = ["codigo_estacao", "data_leitura", *[k for k in rules.key if k in good.columns], *rules.numeric]
            accepted, broken = split(good, row_rules(rules, list(dict.fromkeys(given))))
            found = resolve(accepted)
            found, lost = found if isinstance(found, tuple) else (found, accepted.limit(0))
            kept = lambda df, why: df.select("file", "value", why.alias("reasons"))
            out = [
                kept(flat.where("_none and trim(value) <> ''"), F.array(F.lit(NO_RECORD))),
                kept(bad, F.array("_broken")),
                kept(broken, F.col("reasons")),
                kept(lost, F.array(F.lit(NOT_FOUND))),
            ]
            reduce(DataFrame.unionByName, out).write.mode("overwrite").parquet(f"{_rejected(folder, dataset)}/stream={stream_name(checkpoint)}/batch={number}")
            done = merge(found.select(*[c for c in found.columns if c not in ("file", "value", "codigo_estacao")]), rules, folder)
        finally:
            remove(spark, stage)
        if report:
            report(done)

    return lines(spark, source).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _rejected(folder: str, dataset: str) -> str:
    return f"{folder.rstrip('/')}/_rejected_streams/{dataset}"


def rejected_rows(spark: SparkSession, folder: str, dataset: str) -> DataFrame:
    """(file, value, reasons, stream, batch): the lines of all streams that did not come into the dataset's table, each once."""
    kind = "file string, value string, reasons array<string>, stream string, batch bigint"
    path = _rejected(folder, dataset)
    return spark.read.schema(kind).option("basePath", path).parquet(f"{path}/stream=*") if exists(spark, path) else spark.createDataFrame([], kind)


def dedup_stream(stream: DataFrame, key: list[str], path: str, checkpoint: str, order: list[str | Column]) -> StreamingQuery:
    """Append the rows of a stream whose key is not yet in the table at path; the first of a key stays."""
    from ..operators.keys import keep_first

    def batch(rows: DataFrame, _: int) -> None:
        first = keep_first(rows, key, order)
        if exists(rows.sparkSession, path):
            first = first.join(rows.sparkSession.read.parquet(path).select(*key), key, "left_anti")
        first.write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Progress(StreamingQueryListener):
    """Says how far streams have come: after the first batch, every hundredth, and otherwise no more often than every so many seconds."""

    def __init__(self, say: Callable[[str], None] = log.info, every: int = 100, seconds: float = 5.0, clock: Callable[[], float] = time.monotonic):
        self.say, self.every, self.seconds, self.clock = say, every, seconds, clock
        self.batches, self.rows, self.last = 0, 0, clock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.batches += 1
        self.rows += max(event.progress.numInputRows, 0)
        if self.batches == 1 or self.batches % self.every == 0 or self.clock() - self.last >= self.seconds:
            self.last = self.clock()
            self.say(f"{self.batches} batches, {self.rows} rows")

    def onQueryTerminated(self, event) -> None:
        self.say(f"done: {self.batches} batches, {self.rows} rows")


def daily_counts(stream: DataFrame, at: str, by: list[str], late: str = "7 days") -> DataFrame:
    """Tumbling UTC days of a stream: how many rows each group had."""
    day = F.window(at, "1 day")
    return stream.withWatermark(at, late).groupBy(day, *by).agg(F.count("*").alias("n")).select(F.col("window.start").cast("date").alias("dia"), *by, "n")
