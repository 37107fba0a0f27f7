"""The catalogue's flows: whole tables through files, logs, streams and loads, and read back.

Customers, orders and suppliers stand for readings, events and stations, as in queries.py.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..domain import PARAMETERS, WATER, WEATHER
from ..functions import times
from ..operators import keys, quality
from ..scratch import scratch, written
from ..sources import raw, tables
from ..streaming import ingest
from . import medallion, relational, reports
from .queries import customer_readings, query, table

VALUES = ("temperatura", "ph", "oxigenio_dissolvido", "condutividade", "turbidez")


def keys_alone(spark, d) -> DataFrame:
    """The customers' keys dealt over tasks: a file's keys are a few megabytes, one task's reading, and a line of JSON for each is many times that."""
    return table(spark, d, "customer").select("c_custkey").repartition("c_custkey")


def water_records(rows: DataFrame, key, station, at, temperature) -> DataFrame:
    """rows with their record, a variant as the water endpoint sends it."""
    measures = F.struct(*[F.struct((temperature if v == "temperatura" else F.lit(7.0)).alias("valor")).alias(v) for v in VALUES])
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    body = F.to_json(F.struct(key.cast("string").alias("id"), station.cast("string").alias("estacao_id"), stamp.alias("timestamp"), measures.alias("qualidade_agua")))
    return rows.withColumn("record", F.parse_json(body))


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 2 = 0 THEN 1.0 ELSE 2.0 END AS v FROM customer")
def raw_batches_first_wins(spark, d):
    """Batches of JSON lines written out of order and read oldest first: the first record of an id stays, lines that are none are left out."""
    folder, c = scratch(spark, "raw"), table(spark, d, "customer")
    for day, rows, v in ((2, c, 2.0), (1, c.where("c_custkey % 2 = 0"), 1.0), (3, c, 3.0)):
        records = rows.select(F.parse_json(F.to_json(F.struct(F.col("c_custkey").cast("string").alias("id"), F.lit(v).alias("v")))).alias("record"))
        raw.write_lines(records, WATER.name, "customers", folder, datetime(2026, 1, day, tzinfo=timezone.utc))
    c.select(F.concat(F.lit('{"record": '), F.col("c_custkey").cast("string")).alias("value")).write.text(f"{folder}/api_{WATER.name}_20250101T000000_broken.jsonl")
    rows = raw.read_lines(spark, folder, WATER.name).select("file", "line", F.try_variant_get("record", "$.id", "string").alias("id"), F.try_variant_get("record", "$.v", "double").alias("v"))
    return keys.keep_first(rows, ["id"], ["file", "line"]).select("id", "v")


@query("""SELECT CAST(c_custkey AS VARCHAR) AS id_leitura_origem, CAST(c_nationkey + 1 AS BIGINT) AS id_estacao, code AS codigo_parametro, CASE code WHEN 'TEMP_AGUA' THEN c_custkey % 50 + 0.5 WHEN 'PH' THEN 7.0 ELSE 1.0 END AS valor
FROM customer, (VALUES ('TEMP_AGUA'), ('PH'), ('OD'), ('COND_ELETRICA'), ('TURBIDEZ')) x(code) WHERE c_custkey % 10 BETWEEN 3 AND 6""")
def read_measures_window(spark, d):
    """Readings merged by day, then the long table of four of their ten days, checked as it is read."""
    folder, c = scratch(spark, "measures"), table(spark, d, "customer")
    rows = customer_readings(c, F.col("c_custkey") % 50 + F.lit(0.5), day=F.col("c_custkey") % 10)
    tables.merge(rows.withColumn("id_estacao", F.col("id_estacao") + 1), WATER, folder)
    return reports.read_measures(spark, folder, "2026-01-04", "2026-01-07").select("id_leitura_origem", "id_estacao", "codigo_parametro", "valor")


@query("""WITH c AS (SELECT n_nationkey, row_number() OVER (ORDER BY n_nationkey, n_regionkey) AS id_cidade, n_name FROM nation)
SELECT row_number() OVER (ORDER BY s_name) AS id_estacao, s_name AS codigo_origem, id_cidade, n_name AS nome_cidade, r_name AS nome_estado FROM supplier JOIN c ON s_nationkey = c.n_nationkey JOIN nation n ON n.n_nationkey = s_nationkey JOIN region ON n_regionkey = r_regionkey""".replace("id_cidade, n_name AS nome_cidade", "id_cidade, c.n_name AS nome_cidade"))
def registers_snapshot(spark, d):
    """Regions, nations and suppliers as states, cities and stations: keyed, matched by name, written as one snapshot, replaced by the same and read back."""
    folder = scratch(spark, "registers")
    code = lambda key: F.concat(F.lit("R"), F.col(key).cast("string"))
    state = table(spark, d, "region").select(F.lit(0).alias("id_estado"), F.col("r_regionkey").alias("codigo_ibge_estado"), code("r_regionkey").alias("sigla_estado"), F.col("r_name").alias("nome_estado"))
    nation = table(spark, d, "nation")
    city = nation.select(F.col("n_nationkey").alias("codigo_ibge_cidade"), F.col("n_name").alias("nome_cidade"), code("n_regionkey").alias("sigla_estado"))
    station = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_name").alias("codigo_origem"), F.col("s_name").alias("nome_estacao"), F.lit(1).alias("status_estacao"), F.lower("n_name").alias("cidade"), code("n_regionkey").alias("sigla_estado"))
    for _ in range(2):
        medallion.write_registers(spark, folder, medallion.registers(spark, state, city, station))
    stations, cities, states = medallion.stored_registers(spark, folder)
    return stations.join(cities, "id_cidade").join(states, "id_estado").select("id_estacao", "codigo_origem", "id_cidade", "nome_cidade", "nome_estado")


@query("SELECT CAST(c_custkey AS VARCHAR) AS cpf, c_name AS nome, CASE WHEN c_custkey % 3 = 0 THEN 'ativo' END AS status, CAST(c_nationkey AS VARCHAR) AS estacao_id FROM customer WHERE c_custkey % 5 <> 0")
def documents_of_operators(spark, d):
    """Customers as operators in a document for each nation; those with a blank station are left out."""
    folder, c = scratch(spark, "operators"), table(spark, d, "customer")
    one = F.struct(F.col("c_custkey").cast("string").alias("cpf"), F.col("c_name").alias("nome"), F.when(F.col("c_custkey") % 3 == 0, "ativo").alias("status"), F.when(F.col("c_custkey") % 5 == 0, " ").otherwise(F.col("c_nationkey").cast("string")).alias("estacao_id"))
    c.groupBy("c_nationkey").agg(F.to_json(F.struct(F.lit("2026-01-01").alias("date"), F.collect_list(one).alias("operadores"))).alias("value")).repartition("c_nationkey").write.partitionBy("c_nationkey").text(folder)
    found, _ = relational.read_operators(spark, f"{folder}/*")
    return found.select("cpf", "nome", "status", "estacao_id")


@query("""SELECT l_orderkey, l_linenumber, array_to_string(list_filter([CASE WHEN l_quantity > 45 THEN 'temperatura_ar: out of range' END, CASE WHEN l_discount * 1000 > 90 THEN 'umidade: out of range' END,
CASE WHEN l_linenumber = 7 THEN 'chuva: out of range' END, CASE WHEN l_linenumber = 6 THEN 'vento: missing or no number' END], lambda x: x IS NOT NULL), ', ') AS reasons FROM lineitem""")
def weather_domain_rules(spark, d):
    """Line items as weather readings of which some are too warm, too moist, or without rain or wind."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") + 15).cast("double").alias("temperatura_ar"), (F.col("l_discount") * 1000 + 10).cast("double").alias("umidade"), F.when(F.col("l_linenumber") == 7, -0.5).otherwise(0.0).alias("chuva"), F.when(F.col("l_linenumber") != 6, 0.0).alias("vento"))
    rules = quality.row_rules(WEATHER, list(WEATHER.numeric))
    order = [f"{c}: {w}" for c in WEATHER.numeric for w in ("missing or no number", "out of range")]
    return rows.select("l_orderkey", "l_linenumber", F.array_join(quality.reasons({name: rules[name] for name in order}), ", ").alias("reasons"))


@query("""SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_orderkey % 7 = 1 THEN 'unknown origin' END, CASE WHEN o_orderkey % 7 = 2 THEN 'no key' END, CASE WHEN o_orderkey % 7 = 3 THEN 'key too long' END,
CASE WHEN o_orderkey % 7 = 4 THEN 'no station' END, CASE WHEN o_orderkey % 7 = 5 THEN 'no instant' END, CASE WHEN o_orderkey % 7 = 1 THEN 'key of another reading' END, CASE WHEN o_orderkey % 3 = 1 THEN 'no operator digest' END], lambda x: x IS NOT NULL), ', ') AS reasons FROM orders""")
def header_rules(spark, d):
    """Orders as headers of events, broken in a way of their own."""
    n = F.col("o_orderkey") % 7
    key = F.when(n == 2, "  ").when(n == 3, F.repeat(F.lit("k"), 151)).otherwise(F.col("o_orderkey").cast("string"))
    digest = F.when(F.col("o_orderkey") % 3 == 1, F.lit("abc")).when(F.col("o_orderkey") % 3 == 2, F.sha2(F.col("o_orderpriority"), 256))
    rows = table(spark, d, "orders").select("o_orderkey", F.when(n == 1, "other").otherwise(WATER.name).alias("origem"), key.alias("chave_origem"), F.when(n != 4, F.col("o_custkey")).alias("id_estacao"), F.when(n != 5, F.col("o_orderdate").cast("timestamp")).alias("data_leitura"), digest.alias("operador_cpf_hash"))
    return rows.select("o_orderkey", F.array_join(relational.header_reasons(rows.columns), ", ").alias("reasons"))


@query("SELECT CAST(o_custkey AS BIGINT) AS id_estacao, CAST(date '2026-01-01' + CAST(n AS INTEGER) AS VARCHAR) AS data, o_orderkey % 40 + n AS temperatura_minima, n = 1 AS temperatura_minima_estimada FROM orders, range(3) r(n) WHERE n < o_orderkey % 4")
def collected_temperatures(spark, d):
    """Orders as a collector's results with up to three days, of which a result without any has an empty object."""
    n = (F.col("o_orderkey") % 4).cast("int")
    one = lambda i: F.struct(F.date_add(F.lit("2026-01-01").cast("date"), i.cast("int")).cast("string").alias("data"), (F.col("o_orderkey") % 40 + i).cast("double").alias("temperatura_minima"), (i == 1).alias("temperatura_minima_estimada"))
    head = F.concat(F.lit('{"uf":"SP","id_municipio":"1","id_estacao":'), F.col("o_custkey").cast("string"), F.lit(',"capturado_em":"2026-01-01T00:00:00Z","detalhes_estacao":{},"dados_climaticos":'))
    days = F.when(n == 0, F.lit("{}")).otherwise(F.to_json(F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), one)))
    results = table(spark, d, "orders").select(F.parse_json(F.concat(head, days, F.lit("}"))).alias("result"))
    return raw.climate_rows(results).select("id_estacao", "data", "temperatura_minima", "temperatura_minima_estimada")


LATE = "SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 3 = 0 THEN 20.0 ELSE 30.0 END AS v, CAST(c_custkey % 3 AS BIGINT) AS day FROM customer WHERE c_custkey % 7 <> 0"


@query(f"SELECT id, v, day, CAST(0 AS BIGINT) AS n_rejected FROM ({LATE}) UNION ALL SELECT reason, NULL, NULL, n FROM (SELECT 'temperatura_agua: out of range' AS reason, (SELECT count(*) FROM customer WHERE c_custkey % 7 = 0) + (SELECT count(*) FROM customer WHERE c_custkey % 7 = 0 AND c_custkey % 3 = 0) AS n) UNION ALL SELECT 'line: no record', NULL, NULL, (SELECT count(*) FROM customer)")
def stream_late_days(spark, d):
    """Readings of a later batch for days that are there: streamed, merged into the old days, first of a key wins; what is rejected is counted by reason."""
    root, c = scratch(spark, "late"), keys_alone(spark, d)
    at = F.timestamp_add("day", (F.col("c_custkey") % 3).cast("int"), F.lit("2026-01-01 10:00:00").cast("timestamp"))
    warm = lambda v: F.when(F.col("c_custkey") % 7 == 0, 99.0).otherwise(v)
    first = lambda rows, v: water_records(rows, F.col("c_custkey"), F.lit("E1"), at, warm(v)).select("record")
    raw.write_lines(first(c.where("c_custkey % 3 = 0"), 20.0), WATER.name, "s", f"{root}/in", datetime(2026, 1, 1, tzinfo=timezone.utc))
    stations = written(spark.createDataFrame([("E1", 1, 1)], "codigo_origem string, id_estacao bigint, id_cidade bigint"), "stations")
    resolve = lambda rows: medallion.resolve(rows, WATER, stations)
    for turn in range(2):
        ingest.merge_stream(spark, f"{root}/in", WATER.name, f"{root}/silver", f"{root}/checkpoint", resolve).awaitTermination()
        if turn == 0:
            raw.write_lines(first(c, 30.0), WATER.name, "s", f"{root}/in", datetime(2026, 1, 2, tzinfo=timezone.utc))
            c.select(F.lit("{broken").alias("value")).write.text(f"{root}/in/api_{WATER.name}_broken.jsonl")
    rows = tables.read_table(spark, f"{root}/silver/{WATER.name}").select(F.col("id_leitura_origem").alias("id"), F.col("temperatura_agua").alias("v"), (F.dayofmonth(tables.DAY) - 1).cast("bigint").alias("day"), F.lit(0).cast("bigint").alias("n_rejected"))
    lost = quality.reason_counts(ingest.rejected_rows(spark, f"{root}/silver", WATER.name))
    return rows.unionByName(lost.select(F.col("reason").alias("id"), F.lit(None).cast("double").alias("v"), F.lit(None).cast("bigint").alias("day"), F.col("n").alias("n_rejected")))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS chave_origem, CASE WHEN o_custkey % 4 = 0 OR o_orderkey % 10 IN (4, 8) OR o_orderkey % 6 = 1 THEN 'reject' ELSE 'insert' END AS verdict,
array_to_string(list_filter([CASE WHEN o_custkey % 4 = 0 THEN 'unknown station' END, CASE WHEN o_orderkey % 10 IN (4, 8) THEN 'unknown operator' END, CASE WHEN o_orderkey % 6 = 1 THEN 'unknown parameter' END], lambda x: x IS NOT NULL), ', ') AS reasons FROM orders""")
def event_foreign_keys(spark, d):
    """Orders loaded as events against registers that lack every fourth customer, some operators and a parameter: verdicts and reasons."""
    n = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(n.cast("string").alias("id_leitura_origem"), F.col("o_custkey").alias("id_estacao"), F.when(n % 2 == 0, n % 10).cast("bigint").alias("id_operador"), F.col("o_orderdate").cast("timestamp").alias("data_leitura"), F.lit("20").alias("temperatura_agua"), F.when(n % 6 == 1, "7").alias("ph"), *[F.lit(None).cast("string").alias(c) for c in ("oxigenio", "condutividade", "turbidez")])
    stations = table(spark, d, "customer").select(F.col("c_custkey").alias("id_estacao")).union(table(spark, d, "orders").select("o_custkey")).where("id_estacao % 4 <> 0").distinct()
    operators = table(spark, d, "orders").select((n % 10).alias("id_operador")).where("id_operador not in (4, 8)").distinct()
    known = relational.References(stations, operators, [p[0] for p in PARAMETERS if p[0] != "PH"])
    done = relational.persist(relational.prepare(rows, WATER), scratch(spark, "references"), references=known)
    return done.verdicts.select("chave_origem", "verdict", F.array_join("reasons", ", ").alias("reasons"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS id_leitura_origem, CASE WHEN c_custkey % 10 BETWEEN 2 AND 4 THEN 25.0 ELSE 20.0 END AS temperatura_agua, CAST(c_custkey % 10 AS BIGINT) AS day FROM customer")
def backfill_replaced_days(spark, d):
    """Raw batches loaded by day, then three of the days loaded again from corrected batches, in place of what they had."""
    root, c = scratch(spark, "backfill"), keys_alone(spark, d)
    at = F.timestamp_add("day", (F.col("c_custkey") % 10).cast("int"), F.lit("2026-01-01 10:00:00").cast("timestamp"))
    stations = written(spark.createDataFrame([("E1", 1, 1)], "codigo_origem string, id_estacao bigint, id_cidade bigint"), "stations")
    for name, v in (("first", 20.0), ("corrected", 25.0)):
        raw.write_lines(water_records(c, F.col("c_custkey"), F.lit("E1"), at, F.lit(v)).select("record"), WATER.name, "s", f"{root}/{name}")
    medallion.load(spark, f"{root}/first", f"{root}/silver", stations, [WATER.name])
    medallion.backfill(spark, f"{root}/corrected", f"{root}/silver", stations, WATER.name, "2026-01-03", "2026-01-06", replace=True)
    return tables.read_table(spark, f"{root}/silver/{WATER.name}").select("id_leitura_origem", "temperatura_agua", (F.dayofmonth(times.utc_day(F.col("data_leitura"))) - 1).cast("bigint").alias("day"))
