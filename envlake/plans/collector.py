"""The climate collector: municipalities to stations to daily temperatures, over REST.

Each step is a table of requests, dealt over tasks that share the calls a minute; a
request that fails gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.raw_json import extracted, kind, let
from ..functions.times import strict_day
from ..sources.files import children, remove
from ..sources.raw import climate_rows, get_all
from ..sources.versions import PREFIX, current, leased, new_folder, publish

#: The fields of a result and of a day, and what each must be; * may be missing.
RESULT_FIELDS = {"uf": "text", "id_municipio": "text", "id_estacao": "number", "capturado_em": "text", "detalhes_estacao": "object"}
DAY_NUMBERS = ("temperatura_minima", "temperatura_media", "temperatura_maxima", "precipitacao")


def fetch(requests: DataFrame, token: str, tasks: int = 1, per_minute: int = 30, timeout: float = 15.0) -> DataFrame:
    """requests (url, ...) with the body, a variant, of the answers that are JSON; a token is needed and never logged."""
    if not token or not token.strip():
        raise ValueError("the collector needs a token")
    got = get_all(requests, token, tasks, per_minute, timeout)
    return got.where("status = 200").withColumn("body", F.try_parse_json("body")).where("body is not null").drop("status")


def station_ids(answers: DataFrame) -> DataFrame:
    """answers with id_estacao in place of their body, a row for each station of a list: objects with id or idEstacao, or plain ids."""
    rows = answers.withColumn("s", F.explode(F.try_variant_get("body", "$", "array<variant>")))
    found = F.coalesce(F.try_variant_get("s", "$.id", "bigint"), F.try_variant_get("s", "$.idEstacao", "bigint"), F.try_variant_get("s", "$", "bigint"))
    return rows.withColumn("id_estacao", found).drop("s", "body").where("id_estacao is not null")


def collect(spark: SparkSession, base: str, municipalities: Sequence[tuple[str, str]] | DataFrame, first: str, last: str, token: str, tasks: int = 1, per_minute: int = 30) -> DataFrame:
    """(uf, id_municipio, id_estacao, climate variant) for the stations of the municipalities, a table or a list.

    Both kinds of requests are tables: those for stations are made from the
    municipalities, and those for the climate from the answers. Each step is held to
    the limit by itself.
    """
    strict_day(first), strict_day(last)
    base = F.lit(base.rstrip("/"))
    if not isinstance(municipalities, DataFrame):
        municipalities = spark.createDataFrame(list(municipalities), "uf string, id_municipio string")
    where = F.concat(F.lit("uf="), F.url_encode("uf"), F.lit("&municipio="), F.url_encode("id_municipio"))
    lists = municipalities.select("uf", "id_municipio").distinct().withColumn("url", F.concat(base, F.lit("/estacoes?"), where))
    found = station_ids(fetch(lists, token, tasks, per_minute)).select("uf", "id_municipio", "id_estacao").distinct()
    wanted = found.withColumn("url", F.concat(base, F.lit("/clima/"), F.col("id_estacao").cast("string"), F.lit(f"?inicio={first}&fim={last}&"), where))
    climate = fetch(wanted, token, tasks, per_minute).select("uf", "id_municipio", "id_estacao", F.col("body").alias("climate"))
    return found.join(climate, ["uf", "id_municipio", "id_estacao"], "left")


def result_reasons(column: str = "result") -> Column:
    """Why a collector's result breaks its contract, in order; an empty list if it does not.

    The result is read once, into its fields with their kinds, and so is its list of days.
    """
    return let(F.col(column), lambda r: let(extracted(r, [*RESULT_FIELDS, "dados_climaticos"]), _reasons))


def _reasons(x: Column) -> Column:
    found = {p: x[f"f{i}"] for i, p in enumerate(RESULT_FIELDS)}
    reasons = [F.when(found[p]["kind"].isNull(), f"{p}: missing").when(found[p]["kind"] != k, f"{p}: not a {k}") for p, k in RESULT_FIELDS.items()]
    uf = F.try_variant_get(found["uf"]["v"], "$", "string")
    reasons.append(F.when((found["uf"]["kind"] == "text") & ~uf.rlike(r"^\p{L}{2}$"), "uf: not two letters"))
    days = x[f"f{len(RESULT_FIELDS)}"]
    reasons.append(F.when(days["kind"].isNull(), "dados_climaticos: missing").when(~days["kind"].isin("array", "object"), "dados_climaticos: not a list"))
    listed = F.try_variant_get(days["v"], "$", "array<variant>")
    reasons.append(F.when(F.coalesce(F.exists(listed, _day_breaks), F.lit(False)), "dados_climaticos: a day breaks its contract"))
    return F.filter(F.array(*reasons), lambda r: r.isNotNull())


def _day_breaks(day: Column) -> Column:
    """Whether a day has no date, or a number that is something else; one that is no number and no other kind is missing."""
    date = F.try_variant_get(day, "$.data", "string")
    wrong = let(date, lambda d: d.isNull() | ~d.rlike(r"^\d{4}-\d{2}-\d{2}$") | d.try_cast("date").isNull())
    strange = [F.coalesce(kind(day, name) != "number", F.lit(False)) for name in DAY_NUMBERS]
    return reduce(lambda a, b: a | b, strange, wrong)


def temperatures(results: DataFrame, column: str = "result") -> DataFrame:
    """Daily rows of the results that meet their contract."""
    return climate_rows(results.where(F.size(result_reasons(column)) == 0), column)


def results(spark: SparkSession, path: str) -> DataFrame:
    """(value): the lines of a cumulative file of results, those appended to it and those that lay there before."""
    seen = current(spark, path)
    return _lines(spark, [f"{path.rstrip('/')}/{f['folder']}" for f in seen.content.get("folders", [])] + _foreign(spark, path))


def _foreign(spark: SparkSession, path: str) -> list[str]:
    """Files of the folder that append_results() did not write."""
    return [c for c in children(spark, path) if not c.rstrip("/").rsplit("/", 1)[-1].startswith((PREFIX, "_", "."))]


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    return spark.read.text(list(paths)) if paths else spark.createDataFrame([], "value string")


def append_results(new: DataFrame, path: str, column: str = "result") -> int:
    """Append a collector's results to the JSON lines at path, if these and all that are there meet the contract; how many there are then.

    What was appended before met it then, and is not read again; files of others are
    checked once. The first reasons of those that don't are named, and nothing is
    written. An append is published as one.
    """
    spark, path = new.sparkSession, path.rstrip("/")
    with leased(spark, path) as lease:
        seen = current(spark, path)
        held, foreign = seen.content.get("folders", []), _foreign(spark, path)
        fresh = new_folder()
        new.select(F.to_json(column).alias("value")).write.text(f"{path}/{fresh}")
        checked = {f["folder"]: f["rows"] for f in seen.content.get("foreign", [])}
        unchecked = [f for f in foreign if f not in checked]
        whole = _lines(spark, [f"{path}/{fresh}", *unchecked]).select(F.try_parse_json("value").alias("r"))
        broken = whole.select(F.explode(result_reasons("r")).alias("why")).distinct().orderBy("why").limit(10).collect()
        if broken:
            remove(spark, f"{path}/{fresh}")
            raise ValueError("; ".join(r.why for r in broken))
        checked |= {f: _lines(spark, [f]).count() for f in unchecked}
        folders = [*held, {"folder": fresh, "rows": _lines(spark, [f"{path}/{fresh}"]).count()}]
        publish(spark, path, seen, {"folders": folders, "foreign": [{"folder": f, "rows": n} for f, n in checked.items()]}, lease)
        return sum(f["rows"] for f in folders) + sum(checked.values())
