"""Tables by UTC day: merging, rebuilding, key index, manifests and reports.

A table is a folder of Parquet with a folder dia_utc=YYYY-MM-DD for each day of each
write, and a log that says which of them are valid (sources/versions.py). A merge
adds rows whose key no day has; a rebuild replaces whole days. Both write new folders
beside the old ones and publish once, so readers see the table before or after, and a
killed writer leaves the table as it was.

Beside the rows a write stores a hash of each key with its day. A merge joins the
hashes of its keys with that index, which is a few bytes for a row, and reads the keys
of those days alone in which one is found; most merges read none. A folder of
Parquet by day that has no log is a table, too: its first write gives it one.
"""

from __future__ import annotations

import json
import logging
import os
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..domain import Contract
from ..functions.times import in_utc, utc_day, utc_midnight
from ..operators.keys import duplicate_keys, keep_first
from ..operators.quality import assess, dimension_counts, require_columns, typed
from ..scratch import written
from .files import children, exists, fs_path, remove, write_text
from .versions import PREFIX, Lease, Snapshot, clean, current, leased, new_folder, publish, to_gather

__all__ = ["DAY", "Written", "checked_days", "has_table", "merge", "numbered_lines", "read_days", "read_table", "rebuild", "write_csv", "write_csv_parts", "write_star"]
log = logging.getLogger("envlake.insertion")
DAY = "dia_utc"
#: Folders of a day, and of the index, beyond which a write puts them together.
MOST_FOLDERS = 8
#: Every so many versions old files are looked for.
CLEAN_EVERY = 8


@dataclass
class Written:
    """What a merge or rebuild did."""

    dataset: str
    received: int
    written: int
    days: list[str]
    dimensions: dict[str, dict[str, int]] = field(default_factory=dict)
    manifest: str = ""


def _content(spark: SparkSession, path: str) -> Snapshot:
    """The table's latest snapshot; of a folder without a log, one that lists its days.

    content: days (day to its folders), schema, index (folders with their rows).
    """
    seen = current(spark, path)
    if seen.version or not exists(spark, path):
        return seen
    days = {n.split("=", 1)[1]: [n] for n in (c.rstrip("/").rsplit("/", 1)[-1] for c in children(spark, path)) if n.startswith(f"{DAY}=")}
    if not days:
        return seen
    schema = spark.read.option("mergeSchema", "true").parquet(path).drop(DAY).schema
    return Snapshot(0, {"days": days, "schema": schema.jsonValue(), "index": []})


def has_table(spark: SparkSession, path: str) -> bool:
    return bool(_content(spark, path).content)


def _schema(content: dict[str, Any]) -> StructType:
    return StructType.fromJson(content["schema"])


def _read(spark: SparkSession, path: str, content: dict[str, Any], days: Sequence[str] | None = None) -> DataFrame:
    """The rows of a snapshot, or of some of its days: other days' folders are not even listed."""
    schema = _schema(content).add(DAY, "date")
    wanted = [f for day, folders in content["days"].items() if days is None or day in days for f in folders]
    parts = []
    for versioned in (True, False):
        own = [f"{path}/{f}" for f in wanted if f.startswith(PREFIX) is versioned]
        if own:
            parts.append(spark.read.schema(schema).option("basePath", path).parquet(*own).select(*schema.names))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The table as its latest snapshot has it, whatever is written while it is read."""
    path = path.rstrip("/")
    seen = _content(spark, path)
    if not seen.content:
        raise ValueError(f"{path} is no table by day")
    return _read(spark, path, seen.content)


def read_days(spark: SparkSession, path: str, first: date | None = None, end: date | None = None) -> DataFrame:
    """The rows of the days [first, end); other days' folders are not read."""
    path = path.rstrip("/")
    seen = _content(spark, path)
    if not seen.content:
        raise ValueError(f"{path} is no table by day")
    return _read(spark, path, seen.content, [d for d in seen.content["days"] if (first is None or d >= str(first)) and (end is None or d < str(end))])


def checked_days(df: DataFrame, instant: str) -> DataFrame:
    """df, if every row lies in the day of its folder."""
    n = df.where(utc_day(F.col(instant)) != F.col(DAY)).count()
    if n:
        raise ValueError(f"{n} rows lie outside the day of their folder")
    return df


# The keys of a manifest are published names.
def _manifest(spark: SparkSession, folder: str, done: Written, **more) -> str:
    run = uuid.uuid4().hex
    path = f"{folder.rstrip('/')}/_audit/{done.dataset}/{run}.json"
    content = {"execucao_id": run, "dataset": done.dataset, "executado_em_utc": datetime.now(timezone.utc).isoformat(), "formato": "parquet", "compressao": "snappy"}
    content |= {"linhas_recebidas": done.received, "linhas_gravadas": done.written, "particoes_gravadas": done.days, "dimensoes_qualidade": done.dimensions} | more
    write_text(spark, path, json.dumps(content, ensure_ascii=False, indent=2))
    return path


def _write_days(df: DataFrame, path: str, instant: str) -> dict[str, int]:
    """Write rows below a new folder of the table; how many each day has."""
    # by ranges of time: days that lie together share a task, and a day that is large is split over several, whatever instants it has
    rows = df.withColumn("_tie", F.xxhash64(*df.columns)).repartitionByRange(DAY, instant, "_tie").sortWithinPartitions(DAY, instant).drop("_tie")
    rows.write.option("compression", "snappy").partitionBy(DAY).parquet(path)
    if not any(f"/{DAY}=" in c for c in children(df.sparkSession, path)):
        return {}
    written = df.sparkSession.read.schema(StructType.fromDDL(f"{DAY} date")).parquet(path)
    return {str(r[0]): r[1] for r in written.groupBy(DAY).agg(F.count("*")).collect()}


def _merged(a: StructType, b: StructType, name: str) -> StructType:
    """Both schemas' columns; a column of two kinds is an error."""
    out = StructType.fromJson(a.jsonValue())
    for f in b.fields:
        if f.name not in out.names:
            out.add(f.name, f.dataType, True)
        elif out[f.name].dataType != f.dataType:
            raise ValueError(f"{name}: {f.name} is {out[f.name].dataType.simpleString()}, not {f.dataType.simpleString()}")
    return out


def _hashed(key: Sequence[str]) -> Column:
    return F.xxhash64(*key).alias("hash")


def _indexed(spark: SparkSession, path: str, content: dict[str, Any]) -> DataFrame:
    """(hash, dia_utc) of every key that was ever written; keys of replaced days stay until folders are put together."""
    kind = f"hash bigint, {DAY} date"
    folders = [f"{path}/{i['folder']}" for i in content.get("index", [])]
    return spark.read.schema(kind).parquet(*folders) if folders else spark.createDataFrame([], kind)


def _hit_days(spark: SparkSession, path: str, content: dict[str, Any], new: DataFrame, key: Sequence[str]) -> list[str]:
    """The days of the table in which a key of new may be; a driver's list of days, as a snapshot has them."""
    if not content.get("index"):
        return list(content.get("days", {}))
    found = _indexed(spark, path, content).join(new.select(_hashed(key)).distinct(), "hash")
    return [d for d in (str(r[0]) for r in found.select(DAY).distinct().collect()) if d in content["days"]]


def _index(spark: SparkSession, path: str, content: dict[str, Any], rows: DataFrame, key: Sequence[str]) -> list[dict[str, Any]]:
    """The index with the keys of rows: in a new folder, which also takes in others when there are too many."""
    own = rows.select(_hashed(key), DAY)
    old = content.get("index", [])
    if not old and content.get("days"):  # a table that had no index
        own = own.unionByName(_read(spark, path, content).select(_hashed(key), DAY))
    gathered = to_gather(old, MOST_FOLDERS)
    if gathered:
        own = own.unionByName(_indexed(spark, path, {"index": gathered}))
    folder = f"_keys/{new_folder()}"
    own.write.option("compression", "zstd").parquet(f"{path}/{folder}")
    return [*[i for i in old if i not in gathered], {"folder": folder, "rows": spark.read.parquet(f"{path}/{folder}").count()}]


def _used(content: dict[str, Any]) -> list[str]:
    """The folders that a snapshot needs."""
    return [f.split("/")[0] for folders in content.get("days", {}).values() for f in folders] + [i["folder"] for i in content.get("index", [])]


def _commit(spark: SparkSession, path: str, seen: Snapshot, content: dict[str, Any], lease: Lease) -> None:
    done = publish(spark, path, seen, content, lease)
    if done.version % CLEAN_EVERY == 0:
        clean(spark, path, ("", "_keys"), _used, lease)


def merge(df: DataFrame, contract: Contract, folder: str, order: Sequence[str | Column] | None = None) -> Written:
    """Add the clean rows whose key no day of the table has yet; the first row of a key stays for good.

    order says which of several rows with a key comes first; without it, all
    columns do. A manifest is written even if no row is. Days get a further folder;
    one that has many is put together.
    """
    spark, path = df.sparkSession, f"{folder.rstrip('/')}/{contract.name}"
    with leased(spark, path) as lease:
        seen = _content(spark, path)
        content = seen.content
        stage = f"{folder.rstrip('/')}/_stage/{uuid.uuid4().hex}"
        try:
            # what gives df is computed once, not again for each count
            df.write.parquet(f"{stage}/received")
            clean_rows, counts = assess(spark.read.schema(df.schema).parquet(f"{stage}/received"), contract)
            for c in contract.key:
                if dict(clean_rows.dtypes)[c] == "string":
                    clean_rows = clean_rows.withColumn(c, F.trim(c))
            first = keep_first(clean_rows, contract.key, order or sorted(c for c in clean_rows.columns))
            first.withColumn(DAY, utc_day(F.col(contract.instant))).write.parquet(f"{stage}/first")
            first = spark.read.parquet(f"{stage}/first")
            totals = counts.first().asDict()
            evaluated = clean_rows.count()
            hit = _hit_days(spark, path, content, first, contract.key)
            added = first.join(_read(spark, path, content, hit).select(*contract.key), list(contract.key), "left_anti") if hit else first
            schema = _merged(_schema(content), first.drop(DAY).schema, contract.name) if content else first.drop(DAY).schema
            fresh = new_folder()
            rows = _write_days(added, f"{path}/{fresh}", contract.instant)
            if rows:
                days = {d: list(f) for d, f in content.get("days", {}).items()}
                crowded = [d for d in rows if len(days.get(d, [])) >= MOST_FOLDERS]
                if crowded:
                    one = new_folder()
                    for d in _write_days(_read(spark, path, content, crowded), f"{path}/{one}", contract.instant):
                        days[d] = [f"{one}/{DAY}={d}"]
                for d in rows:
                    days[d] = [*days.get(d, []), f"{fresh}/{DAY}={d}"]
                index = _index(spark, path, content, spark.read.schema(first.schema).parquet(f"{path}/{fresh}"), contract.key)
                _commit(spark, path, seen, {"days": dict(sorted(days.items())), "schema": schema.jsonValue(), "index": index}, lease)
            else:
                remove(spark, f"{path}/{fresh}")
            approved = sum(rows.values())
            dimensions = {r.dimension: {"linhas_avaliadas": r.evaluated, "linhas_aprovadas": r.approved, "linhas_rejeitadas": r.rejected} for r in dimension_counts(counts, (evaluated, approved)).collect()}
        finally:
            remove(spark, stage)
        done = Written(contract.name, totals["received"], approved, sorted(rows), dimensions)
        done.manifest = _manifest(spark, folder, done)
        return done


def rebuild(load: Callable[[], DataFrame], contract: Contract, folder: str, start: datetime, end: datetime) -> Written:
    """Replace the days [start, end) by what load() returns, all or nothing.

    Every row must be clean, in the window and with a key that neither repeats nor
    is in a day outside it. Days of the table in the window without new rows become
    empty.
    """
    a, b = utc_midnight(start), utc_midnight(end)
    if a >= b:
        raise ValueError("the window is empty")
    first, last = a.date(), b.date()
    df = load()
    spark, path = df.sparkSession, f"{folder.rstrip('/')}/{contract.name}"
    with leased(spark, path) as lease:
        require_columns(df, contract.required, contract.name)
        seen = _content(spark, path)
        content = seen.content
        stage = f"{folder.rstrip('/')}/_stage/{uuid.uuid4().hex}"
        try:
            typed(df, contract).withColumn(DAY, utc_day(F.col(contract.instant))).write.parquet(f"{stage}/new")
            rows = spark.read.parquet(f"{stage}/new")
            good, counts = assess(rows, contract)
            received, kept = counts.first()["received"], good.count()
            if kept != received:
                raise ValueError(f"{received - kept} of {received} rows fail a quality dimension")
            if not duplicate_keys(rows, contract.key).isEmpty():
                raise ValueError("a key repeats")
            if not rows.where((F.col(DAY) < F.lit(first)) | (F.col(DAY) >= F.lit(last))).isEmpty():
                raise ValueError("a row lies outside the window")
            days = content.get("days", {})
            inside = [d for d in days if str(first) <= d < str(last)]
            outside = [d for d in _hit_days(spark, path, content, rows, contract.key) if d not in inside]
            if outside and not _read(spark, path, content, outside).join(rows.select(*contract.key), list(contract.key), "left_semi").isEmpty():
                raise ValueError("a key is in a day outside the window")
            before = {str(r[0]): r[1] for r in _read(spark, path, content, inside).groupBy(DAY).agg(F.count("*")).collect()} if inside else {}
            schema = _merged(_schema(content), rows.drop(DAY).schema, contract.name) if content else rows.drop(DAY).schema
            fresh = new_folder()
            after = _write_days(rows, f"{path}/{fresh}", contract.instant)
            if after or inside:
                left = {d: f for d, f in days.items() if d not in inside} | {d: [f"{fresh}/{DAY}={d}"] for d in after}
                index = _index(spark, path, content, rows, contract.key)
                _commit(spark, path, seen, {"days": dict(sorted(left.items())), "schema": schema.jsonValue(), "index": index}, lease)
            if not after:
                remove(spark, f"{path}/{fresh}")
            dimensions = {r.dimension: {"linhas_avaliadas": r.evaluated, "linhas_aprovadas": r.approved, "linhas_rejeitadas": r.rejected} for r in dimension_counts(counts, (received, received)).collect()}
        finally:
            remove(spark, stage)
        touched = sorted(before.keys() | after.keys())
        done = Written(contract.name, received, received, touched, dimensions)
        parts = [{"caminho": f"{DAY}={d}", "linhas_anteriores": before.get(d, 0), "linhas_finais": after.get(d, 0)} for d in touched]
        done.manifest = _manifest(spark, folder, done, modo="reconstrucao", inicio_utc=a.isoformat(), fim_exclusivo_utc=b.isoformat(), particoes=parts)
        return done


def _report_text(df: DataFrame) -> list[Column]:
    """The columns of a report: booleans as words, instants in UTC with their offset."""
    at = lambda c, t: F.concat(F.date_format(in_utc(F.col(c)) if t == "timestamp" else F.col(c), "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias(c)
    return [F.when(F.col(c), "True").when(~F.col(c), "False").alias(c) if t == "boolean" else at(c, t) if t.startswith("timestamp") else F.col(c) for c, t in df.dtypes]


def write_csv(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """One CSV file for a small report: sorted, with ; and a byte order mark, nulls empty, True and False.

    Spark writes the sorted parts and the driver puts them together; write_csv_parts() is for reports with a row for each measure.
    """
    spark = df.sparkSession
    text = _report_text(df)
    stage = f"{path}.{uuid.uuid4().hex}.stage"
    try:
        df.orderBy(*order).select(*text).write.option("sep", ";").option("emptyValue", "").option("nullValue", "").csv(stage)
        fs, folder = fs_path(spark, stage)
        _, target = fs_path(spark, path)
        part = target.suffix(f".{uuid.uuid4().hex}.part")
        jvm = spark.sparkContext._jvm
        out = fs.create(part, True)
        try:
            out.write(bytearray(("﻿" + ";".join(df.columns) + "\n").encode()))
            for name in sorted(f.getPath().getName() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-")):
                stream = fs.open(jvm.org.apache.hadoop.fs.Path(folder, name))
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 16, False)
                finally:
                    stream.close()
        finally:
            out.close()
        if fs.exists(target):
            fs.delete(target, False)
        fs.rename(part, target)
    finally:
        remove(spark, stage)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(place, line): the lines of a text file of any size with their places from 0 on.

    Tasks take ranges of the file; the lines of each are numbered and shifted by the
    counts of the ranges before it. They are written once, so that no later reading
    cuts the file otherwise.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    lines = written(text.select(F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_at"), F.col("value").alias("line")), "lines")
    counts = written(lines.groupBy("_block").agg(F.count("*").alias("_n"), F.min("_at").alias("_first")), "counts")
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("_block", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return lines.join(shift, "_block").select((F.col("_at") + F.col("_shift")).alias("place"), "line")


def write_csv_parts(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """The same dialect as a folder of sorted parts, each with its header; their names are in the order of the rows. Nothing passes the driver."""
    df.orderBy(*order).select(*_report_text(df)).write.mode("overwrite").option("sep", ";").option("header", "true").option("emptyValue", "").option("nullValue", "").csv(path)


def write_star(tables: dict[str, DataFrame], folder: str, source: str | None = None) -> None:
    """The tables of a star schema as Parquet; the folder must not lie inside the source."""
    if source is not None and os.path.commonpath([os.path.abspath(folder), os.path.abspath(source)]) == os.path.abspath(source):
        raise ValueError("the output lies inside the source")
    for name, df in tables.items():
        df.write.mode("overwrite").option("compression", "snappy").parquet(f"{folder.rstrip('/')}/{name}")
