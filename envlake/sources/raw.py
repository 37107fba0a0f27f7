"""Raw records: files, append-only JSON lines, REST endpoints and registers."""

from __future__ import annotations

import time
import urllib.parse
import urllib.request
import uuid
from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..domain import ENVELOPES, RAW_FIELDS, contract
from ..functions.numbers import number, strict_id
from ..functions.raw_json import first_violation
from ..functions.text import station_label, trimmed
from ..functions.times import instant
from ..scratch import written


def records(payload: DataFrame, dataset: str, body: str = "body") -> DataFrame:
    """One variant record for each in the payloads: a list, an envelope with the dataset's list, or one record."""
    contract(dataset)
    parsed = F.try_parse_json(F.col(body))
    tag = F.schema_of_variant(parsed)
    listed = F.try_variant_get(parsed, f"$.{ENVELOPES[dataset]}", "array<variant>")
    found = F.when(tag.startswith("ARRAY"), F.try_variant_get(parsed, "$", "array<variant>")).when(listed.isNotNull(), listed).when(tag.startswith("OBJECT"), F.array(parsed))
    return payload.withColumn("_found", found).select(*[c for c in payload.columns if c != body], F.posexplode("_found").alias("position", "record"))


def whole_files(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """The records of JSON files, each one document, in order of file and position."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("body"))
    return records(files, dataset)


def read_lines(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """(file, line, record): the records of all batches of a dataset.

    Batches are ordered by name, which begins with the time, whether they are a file or
    a folder of parts, and lines by their place in it. Blank or malformed lines and lines without a record
    are left out. Order a first-wins rule by (file, line).
    """
    lines = spark.read.text(f"{path.rstrip('/')}/api_{dataset}_*.jsonl")
    batch = F.regexp_extract("_metadata.file_path", r"(api_[^/]*\.jsonl(/.*)?)$", 1)
    rows = lines.select(batch.alias("file"), F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n")).alias("line"), F.try_parse_json("value").alias("v"))
    record = F.try_variant_get("v", "$.record", "variant")
    return rows.where(record.isNotNull()).select("file", "line", record.alias("record"))


def write_lines(approved: DataFrame, dataset: str, source: str, path: str, at: datetime | None = None) -> DataFrame:
    """Append a batch of records as JSON lines {ingested_at, source, dataset, record}."""
    stamp = (at or datetime.now(timezone.utc)).strftime("%Y%m%dT%H%M%S%f")
    line = F.to_json(F.struct(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("ingested_at"), F.lit(source).alias("source"), F.lit(dataset).alias("dataset"), "record"))
    out = approved.select(line.alias("value"))
    out.write.mode("append").text(f"{path.rstrip('/')}/api_{dataset}_{stamp}_{uuid.uuid4().hex}.jsonl")
    return out


def approve(raw: DataFrame, dataset: str, record: str = "record") -> tuple[DataFrame, DataFrame]:
    """(approved, rejected with reason) records by the dataset's contract."""
    contract(dataset)
    marked = raw.withColumn("reason", first_violation(F.col(record), RAW_FIELDS[dataset]))
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


# Where a raw record keeps each column of its dataset.
_WATER_PATHS = {"temperatura_agua": "temperatura", "ph": "ph", "oxigenio": "oxigenio_dissolvido", "condutividade": "condutividade", "turbidez": "turbidez"}
_WEATHER_PATHS = {"temperatura_ar": "temperatura_ar.valor", "umidade": "umidade.valor", "chuva": "chuva.valor", "vento": "vento.velocidade"}


def flatten(raw: DataFrame, dataset: str, record: str = "record") -> DataFrame:
    """Records as rows with the dataset's columns; numbers in text are read, what can't be is null."""
    at = lambda path: F.try_variant_get(F.col(record), f"$.{path}", "string")
    rest = [c for c in raw.columns if c != record]
    shared = [trimmed(at("estacao_id")).alias("codigo_estacao"), instant(at("timestamp")).alias("data_leitura")]
    if dataset == "qualidade_agua":
        return raw.select(*rest, trimmed(at("id")).alias("id_leitura_origem"), *shared, *[number(at(f"qualidade_agua.{p}.valor")).alias(c) for c, p in _WATER_PATHS.items()])
    place = [trimmed(at("cidade")).alias("cidade"), trimmed(at("estado")).alias("estado")]
    return raw.select(*rest, *shared, *place, *[number(at(f"dados_meteorologicos.{p}")).alias(c) for c, p in _WEATHER_PATHS.items()], trimmed(at("dados_meteorologicos.condicao.description")).alias("condicao"))


class RateLimit:
    """At most n calls in any 60 seconds; clock and sleep can be replaced."""

    WINDOW = 60.0

    def __init__(self, per_minute: int, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        if isinstance(per_minute, bool) or not isinstance(per_minute, int) or per_minute < 1:
            raise ValueError("the limit must be a positive whole number")
        self.per_minute, self.clock, self.sleep = per_minute, clock, sleep
        self.calls: deque[float] = deque()

    def wait(self) -> None:
        while True:
            now = self.clock()
            while self.calls and now - self.calls[0] >= self.WINDOW:
                self.calls.popleft()
            if len(self.calls) < self.per_minute:
                self.calls.append(now)
                return
            self.sleep(self.WINDOW - (now - self.calls[0]))


@dataclass(frozen=True)
class Ingested:
    """What an ingestion did; ok is false if the endpoint could not be read."""

    dataset: str
    received: int = 0
    approved: int = 0
    rejected: int = 0
    path: str | None = None
    ok: bool = True
    reasons: list[str] = field(default_factory=list)


class RestSource(DataSource):
    """spark.read.format("rest"): a row (url, body) for each of the option urls, newline-separated; GET with an optional bearer token."""

    @classmethod
    def name(cls) -> str:
        return "rest"

    def schema(self) -> str:
        return "url string, status int, body string"

    def reader(self, schema) -> DataSourceReader:
        return _RestReader(dict(self.options))


class _RestReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.token, self.timeout = options.get("token"), float(options.get("timeout", "15"))
        self.per_minute = int(options.get("perminute", "30"))
        self.tasks = max(1, min(int(options.get("tasks", "1")), self.per_minute))  # each has a call a minute at least
        for url in self.urls:
            if urllib.parse.urlsplit(url).scheme not in ("http", "https"):
                raise ValueError("only http and https endpoints can be read")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(self.tasks)]

    def read(self, partition: InputPartition) -> Iterator[tuple[str, int, str | None]]:
        limit = RateLimit(self.per_minute // self.tasks)
        for url in self.urls[partition.value :: self.tasks]:
            limit.wait()
            yield url, *_get(url, self.token, self.timeout)


def _get(url: str, token: str | None, timeout: float) -> tuple[int, str | None]:
    """(status, body) of a GET; a request that fails has no body."""
    request = urllib.request.Request(url, headers={"Authorization": f"Bearer {token}"} if token else {})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return answer.status, answer.read().decode()
    except OSError as e:
        return getattr(e, "code", 0) or 0, None


def get_all(requests: DataFrame, token: str | None = None, tasks: int = 1, per_minute: int = 30, timeout: float = 15.0, url: str = "url") -> DataFrame:
    """requests, a table with an address in each row, with the status and body of its answer; written once, so no request is repeated.

    The rows are dealt to a fixed number of tasks. Each has an equal share of the calls
    a minute, so all of them together keep the limit, whenever they run.
    """
    share = RateLimit(per_minute).per_minute  # checks the limit
    tasks = max(1, min(tasks, share))
    if not requests.where(~F.col(url).rlike("^https?://")).isEmpty():
        raise ValueError("only http and https endpoints can be read")

    def call(batches):
        limit = RateLimit(share // tasks)
        for batch in batches:
            found = []
            for address in batch[url]:
                limit.wait()
                found.append(_get(address, token, timeout))
            yield batch.assign(status=[s for s, _ in found], body=[b for _, b in found])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema.fields)
    numbered = requests.withColumn("_task", F.pmod(F.xxhash64(url), F.lit(tasks)).cast("int"))
    dealt = numbered.repartition(tasks, "_task").drop("_task")
    return written(dealt.mapInPandas(call, f"{kinds}, status int, body string"), "answers")


def ingest(spark: SparkSession, url: str, dataset: str, path: str, label: str | None = None, token: str | None = None, per_minute: int = 30, timeout: float = 15.0) -> Ingested:
    """Read an endpoint, keep the records that meet the contract as a new batch, and say what was done."""
    contract(dataset)
    if urllib.parse.urlsplit(url).scheme not in ("http", "https"):
        raise ValueError("only http and https endpoints can be read")
    spark.dataSource.register(RestSource)
    options = {"urls": url, "perminute": str(per_minute), "timeout": str(timeout)} | ({"token": token} if token else {})
    answer = spark.read.format("rest").options(**options).load().cache()
    try:
        got = answer.first()
        if got is None or got.body is None or got.status != 200:
            return Ingested(dataset, ok=False)
        if not got.body.strip():
            return Ingested(dataset)
        if answer.where(F.try_parse_json("body").isNull()).count():
            return Ingested(dataset, ok=False)
        approved, rejected = approve(records(answer.select("body"), dataset), dataset)
        n, bad = approved.count(), rejected.count()
        if n:
            parts = urllib.parse.urlsplit(url)
            write_lines(approved, dataset, label or f"{parts.hostname}{parts.path}", path)
        return Ingested(dataset, n + bad, n, bad, path if n else None, True, [r.reason for r in rejected.select("reason").limit(10).collect()])
    finally:
        answer.unpersist()


def states(spark: SparkSession, path: str) -> DataFrame:
    """The register of states."""
    rows = spark.read.option("multiLine", "true").schema("id string, ibge string, sigla string, nome string").json(path)
    return rows.select(strict_id(F.col("id"), "id_estado").alias("id_estado"), strict_id(F.col("ibge"), "codigo_ibge_estado").alias("codigo_ibge_estado"), F.upper(F.trim("sigla")).alias("sigla_estado"), F.trim("nome").alias("nome_estado")).distinct()


def cities(spark: SparkSession, path: str) -> DataFrame:
    """The register of cities; repeated ones count once."""
    rows = spark.read.option("multiLine", "true").schema("ibge string, cidade string, sigla_estado string").json(path)
    return rows.select(strict_id(F.col("ibge"), "codigo_ibge_cidade").alias("codigo_ibge_cidade"), F.trim("cidade").alias("nome_cidade"), F.upper(F.trim("sigla_estado")).alias("sigla_estado")).distinct()


def stations(spark: SparkSession, path: str) -> DataFrame:
    """The register of stations, with their displayed names and status 1 or 0."""
    station = "struct<id: string, tipo: string, nome: string, descricao: string, status: string, localizacao: struct<estado: string, city_name: string>>"
    rows = spark.read.option("multiLine", "true").schema(f"estacoes_ambientais array<{station}>").json(path)
    rows = rows.select(F.explode("estacoes_ambientais").alias("s")).select("s.*")
    return rows.select(
        F.trim("id").alias("codigo_origem"),
        station_label(F.col("nome"), F.col("descricao"), F.col("status")).alias("nome_estacao"),
        (F.col("status") == "ativa").cast("int").alias("status_estacao"),
        F.col("localizacao.city_name").alias("cidade"),
        F.upper(F.trim("localizacao.estado")).alias("sigla_estado"),
    )


def climate_rows(results: DataFrame, column: str = "result") -> DataFrame:
    """(uf, station, day, temperatures, rain) of collector results; an empty object in place of the list is no rows."""
    day = "struct<data:string,temperatura_minima:double,temperatura_minima_estimada:boolean,temperatura_media:double,temperatura_maxima:double,temperatura_maxima_estimada:boolean,precipitacao:double>"
    got = F.try_variant_get(F.col(column), "$.dados_climaticos", f"array<{day}>")
    at = lambda path, kind: F.try_variant_get(F.col(column), f"$.{path}", kind)
    rows = results.select(at("uf", "string").alias("uf"), at("id_estacao", "bigint").alias("id_estacao"), F.explode(got).alias("d"))
    return rows.select("uf", "id_estacao", "d.*")


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None, split: tuple[str, int, int, int] | None = None) -> DataFrame:
    """A whole table of a database, or a query in parentheses with a name; split (column, low, high, parts) reads it in as many ranges at once."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**(properties or {}))
    if split:
        for name, value in zip(("partitionColumn", "lowerBound", "upperBound", "numPartitions"), split, strict=True):
            reader = reader.option(name, value)
    return reader.load()
