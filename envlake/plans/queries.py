"""The catalogue: each operator applied to whole tables, and the SQL that gives the same rows.

Suppliers and users stand for stations, line items and events for readings, event
types and numeric columns for parameters. Doubles are rounded on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..domain import WATER
from ..functions import numbers, personal, raw_json, text, times
from ..operators import constraints, joins, keys, quality, reshape, star, statistics, upsert
from ..scratch import scratch
from ..sources import raw, tables, versions
from . import collector, relational

Query = Callable[[SparkSession, str], DataFrame]
CATALOGUE: dict[str, tuple[Query, str | None]] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        CATALOGUE[f.__name__] = (f, sql)
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def customer_readings(customers: DataFrame, temperature, day) -> DataFrame:
    """Customers as water readings of a temperature, on a day from 0 on."""
    at = (F.lit("2026-01-01").cast("timestamp_ntz") + F.make_dt_interval(day.cast("int"))).cast("timestamp")
    value = temperature if isinstance(temperature, Column) else F.lit(temperature)
    return customers.select(F.col("c_custkey").cast("string").alias("id_leitura_origem"), F.col("c_nationkey").cast("bigint").alias("id_estacao"), at.alias("data_leitura"), value.alias("temperatura_agua"), F.lit(7.0).alias("ph"), *[F.lit(1.0).alias(c) for c in ("oxigenio", "condutividade", "turbidez")])


def rounded(df: DataFrame, *columns: str, places: int = 7) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def event_measures(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(F.lit("events").alias("dataset"), F.col("user_id").alias("id_estacao"), F.col("event_type").alias("codigo_parametro"), F.lit("u").alias("unidade_medida"), F.col("event_id").cast("string").alias("id_leitura_origem"), F.col("ts").alias("data_leitura"), F.col("value").alias("valor"))


def line_measures(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("id_estacao"), "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    long = reshape.long_table(rows, ["id_estacao"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "codigo_parametro", "valor")
    return long.select(F.lit("lineitem").alias("dataset"), "id_estacao", "codigo_parametro", F.lit("u").alias("unidade_medida"), "valor")


LONG = "SELECT 'lineitem' AS dataset, l_suppkey AS id_estacao, codigo_parametro, valor FROM (UNPIVOT (SELECT l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem) ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME codigo_parametro VALUE valor)"
STATS = "count(valor) AS n_validos, count(*) - count(valor) AS n_invalidos, round(avg(valor), 7) AS media, round(quantile_cont(valor, 0.5), 7) AS mediana, round(stddev_samp(valor), 7) AS desvio_padrao, round(var_samp(valor), 2) AS variancia, round(quantile_cont(valor, 0.25), 7) AS q1, round(quantile_cont(valor, 0.75), 7) AS q3, round(quantile_cont(valor, 0.75) - quantile_cont(valor, 0.25), 7) AS iqr"


@query(f"SELECT id_estacao, codigo_parametro, {STATS} FROM ({LONG}) GROUP BY ALL")
def stats_describe(spark, d):
    found = statistics.describe(line_measures(spark, d))
    return rounded(rounded(found, "media", "mediana", "desvio_padrao", "q1", "q3", "iqr"), "variancia", places=2).drop("dataset", "unidade_medida", "ddof")


@query(f"SELECT s AS id_estacao, {STATS} FROM (SELECT CAST(event_id AS VARCHAR) AS s, value AS valor FROM events) GROUP BY ALL")
def stats_single_sample(spark, d):
    rows = event_measures(spark, d).withColumn("id_estacao", F.col("id_leitura_origem"))
    found = statistics.describe(rows, by=["id_estacao"])
    return rounded(rounded(found, "media", "mediana", "desvio_padrao", "q1", "q3", "iqr"), "variancia", places=2).drop("ddof")


Z = """WITH g AS (SELECT event_id, user_id, event_type, value, count(value) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS s
FROM events WINDOW w AS (PARTITION BY user_id, event_type)),
z AS (SELECT *, CASE WHEN value IS NULL THEN 'medida_invalida' WHEN n < 2 THEN 'amostra_insuficiente' WHEN s = 0 THEN 'desvio_zero' ELSE 'avaliado' END AS status FROM g)"""


@query(Z + " SELECT CAST(event_id AS VARCHAR) AS id_leitura_origem, n AS n_validos, round(m, 7) AS media, round(s, 7) AS desvio_padrao, status AS status_zscore, round(CASE WHEN status = 'avaliado' THEN (value - m) / s END, 7) AS z_score, CASE WHEN status = 'avaliado' THEN abs((value - m) / s) > 3 END AS anomalia_zscore FROM z")
def zscore_rows(spark, d):
    found = statistics.z_scores(event_measures(spark, d))
    return rounded(found, "media", "desvio_padrao", "z_score").select("id_leitura_origem", "n_validos", "media", "desvio_padrao", "status_zscore", "z_score", "anomalia_zscore")


@query(Z + " SELECT status AS status_zscore, count(*) AS n FROM z GROUP BY status")
def zscore_status_counts(spark, d):
    return statistics.status_counts(statistics.z_scores(event_measures(spark, d)))


IQR = """q AS (SELECT user_id, event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY ALL),
i AS (SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value, q1, q3, e.value < q1 - 1.5 * (q3 - q1) OR e.value > q3 + 1.5 * (q3 - q1) AS flag FROM events e JOIN q USING (user_id, event_type))"""


@query(f"WITH {IQR} SELECT CAST(event_id AS VARCHAR) AS id_leitura_origem, round(q1, 7) AS q1, round(q3, 7) AS q3, round(q1 - 1.5 * (q3 - q1), 7) AS limite_inferior_iqr, round(q3 + 1.5 * (q3 - q1), 7) AS limite_superior_iqr, flag AS anomalia_iqr FROM i")
def iqr_flags(spark, d):
    found = statistics.iqr_flags(event_measures(spark, d))
    return rounded(found, "q1", "q3", "limite_inferior_iqr", "limite_superior_iqr").select("id_leitura_origem", "q1", "q3", "limite_inferior_iqr", "limite_superior_iqr", "anomalia_iqr")


@query(f"{Z}, {IQR} SELECT CAST(i.event_id AS VARCHAR) AS id_leitura_origem, flag AS anomalia_iqr, CASE WHEN status = 'avaliado' THEN abs((z.value - m) / s) > 3 END AS anomalia_zscore, coalesce(flag, false) OR coalesce(CASE WHEN status = 'avaliado' THEN abs((z.value - m) / s) > 3 END, false) AS alerta_qualidade FROM i JOIN z USING (event_id)")
def alerts_combined(spark, d):
    return statistics.alerts(event_measures(spark, d)).select("id_leitura_origem", "anomalia_iqr", "anomalia_zscore", "alerta_qualidade")


@query("""WITH q AS (SELECT user_id, event_type, count(*) AS n, avg(value) AS m, stddev_samp(value) AS s, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3 FROM events WHERE value IS NOT NULL GROUP BY ALL)
SELECT CAST(event_id AS VARCHAR) AS id_leitura_origem, n, round(m, 7) AS media, round(q2, 7) AS mediana, round(CASE WHEN s > 0 THEN (value - m) / s END, 7) AS z_score, coalesce(CASE WHEN s > 0 THEN abs((value - m) / s) >= 3 END, false) AS anomalia_z,
value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) AS anomalia_iqr FROM events JOIN q USING (user_id, event_type) WHERE value IS NOT NULL""")
def sql_dialect_anomalies(spark, d):
    found = statistics.sql_anomalies(event_measures(spark, d))
    return rounded(found, "media", "mediana", "z_score").select("id_leitura_origem", "n", "media", "mediana", "z_score", "anomalia_z", "anomalia_iqr")


@query("SELECT CAST(event_id AS VARCHAR) AS id_leitura_origem, round(avg(value) OVER (PARTITION BY user_id, event_type ORDER BY ts, CAST(event_id AS VARCHAR) ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 7) AS media_movel FROM events")
def rolling_mean_7(spark, d):
    found = statistics.rolling_mean(event_measures(spark, d), ("dataset", "id_estacao", "codigo_parametro"), ("data_leitura", "id_leitura_origem"))
    return rounded(found, "media_movel").select("id_leitura_origem", "media_movel")


@query("SELECT CAST(date_trunc('day', min(ts)) AS DATE) AS first_day, CAST(date_trunc('day', max(ts)) + INTERVAL 1 DAY AS DATE) AS end_day FROM events")
def report_period(spark, d):
    return statistics.period_of(event_measures(spark, d)).toDF("first_day", "end_day")


@query("SELECT l_orderkey AS id, CAST(CAST(l_quantity AS DECIMAL(18,6)) AS DOUBLE) AS quantity, CAST(l_shipdate AS DATE) AS day, CAST(TRY_CAST(l_returnflag AS DOUBLE) AS DOUBLE) AS flag_number FROM lineitem WHERE l_quantity >= 45")
def scan_project_cast(spark, d):
    rows = table(spark, d, "lineitem").where("l_quantity >= 45")
    return rows.select(F.col("l_orderkey").alias("id"), F.col("l_quantity").cast("decimal(18,6)").cast("double").alias("quantity"), times.utc_day(F.col("l_shipdate")).alias("day"), numbers.number(F.col("l_returnflag")).alias("flag_number"))


@query("SELECT 'W' || event_id AS id_leitura_origem, CASE WHEN user_id % 5 <> 0 THEN 'E' || user_id END AS codigo_estacao, ts AS data_leitura, CASE WHEN event_id % 4 <> 0 THEN round(value, 6) END AS temperatura_agua, CAST(json_extract(props, '$.k') AS DOUBLE) AS ph, CAST(NULL AS DOUBLE) AS oxigenio FROM events")
def json_flatten_props(spark, d):
    """Events as raw water records, numbers as text among them, flattened to rows."""
    e = table(spark, d, "events")
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").cast("string")
    number = F.when(F.col("event_id") % 4 == 0, F.lit('"none"')).when(F.col("event_id") % 2 == 0, F.concat(F.lit('"'), F.col("value").cast("string"), F.lit('"'))).otherwise(F.col("value").cast("string"))
    station = F.when(F.col("user_id") % 5 == 0, F.lit('" "')).otherwise(F.concat(F.lit('" E'), F.col("user_id").cast("string"), F.lit(' "')))
    at = F.concat(F.date_format(times.in_utc(F.col("ts")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    text_of = F.concat(F.lit('{"id":"W'), "event_id", F.lit('","estacao_id":'), station, F.lit(',"timestamp":"'), at, F.lit('","qualidade_agua":{"temperatura":{"valor":'), number, F.lit('},"ph":{"valor":'), F.coalesce(k, F.lit("null")), F.lit("}}}"))
    rows = raw.flatten(e.select(F.try_parse_json(text_of).alias("record")), "qualidade_agua")
    return rounded(rows, "temperatura_agua", places=6).select("id_leitura_origem", "codigo_estacao", "data_leitura", "temperatura_agua", "ph", "oxigenio")


@query("""SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'id: missing' WHEN 1 THEN 'id: not a text' WHEN 2 THEN 'id: blank' WHEN 3 THEN 'at: not an ISO instant'
WHEN 4 THEN 'at: without a time zone' WHEN 5 THEN 'm.v: not a number' END AS reason FROM events""")
def json_contract_reasons(spark, d):
    """Raw records made from events, six of seven broken in a way of their own."""
    i = F.col("event_id") % 7
    ident = F.when(i == 0, "null").when(i == 1, "7").when(i == 2, '"  "').otherwise('"a"')
    at = F.when(i == 3, '"ontem"').when(i == 4, '"2026-01-01T00:00:00"').otherwise('"2026-01-01T00:00:00-03:00"')
    value = F.when(i == 5, '"1.5"').otherwise("1.5")
    record = F.try_parse_json(F.concat(F.lit('{"id":'), ident, F.lit(',"at":'), at, F.lit(',"m":{"v":'), value, F.lit('},"extra":1}')))
    fields = [("id", "text"), ("at", "instant"), ("m.v", "number")]
    return table(spark, d, "events").select("event_id", raw_json.first_violation(record, fields).alias("reason"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS id_leitura_origem, CAST(c_nationkey AS BIGINT) AS id_estacao, code AS codigo_parametro, CASE WHEN code = 'PH' THEN c_acctbal END AS valor FROM customer, (VALUES ('TEMP_AGUA'), ('PH'), ('OD'), ('COND_ELETRICA'), ('TURBIDEZ')) v(code)")
def missing_column_default(spark, d):
    """Readings with one measure alone, as long measures of all: those of columns that are not there are null."""
    rows = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id_leitura_origem"), F.col("c_nationkey").cast("bigint").alias("id_estacao"), F.lit("2026-01-01").cast("timestamp").alias("data_leitura"), F.col("c_acctbal").alias("ph"))
    return reshape.measurements(rows, WATER).select("id_leitura_origem", "id_estacao", "codigo_parametro", "valor")


@query("SELECT c_custkey, lower(trim(c_mktsegment)) AS segment, CASE WHEN trim(c_name) <> '' THEN trim(c_name) END AS name FROM customer")
def key_normalisation(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.lower(F.trim("c_mktsegment")).alias("segment"), text.trimmed(F.col("c_name")).alias("name"))


@query("SELECT p_partkey, regexp_replace(lower(p_name), '[^a-z0-9]', '', 'g') AS key FROM part")
def text_match_key(spark, d):
    return table(spark, d, "part").select("p_partkey", text.match_key(F.col("p_name")).alias("key"))


@query("SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN trim(concat(s_name, ' - ', CAST(s_nationkey AS VARCHAR))) ELSE concat('[Desativado] ', trim(concat(s_name, ' - ', CAST(s_nationkey AS VARCHAR)))) END AS label FROM supplier")
def station_labels(spark, d):
    status = F.when(F.col("s_acctbal") > 0, "ativa").otherwise("inativa")
    return table(spark, d, "supplier").select("s_suppkey", text.station_label(F.col("s_name"), F.col("s_nationkey").cast("string"), status).alias("label"))


RULE_SQL = "CASE WHEN l_quantity > 40 THEN ['quantity'] ELSE [] END || CASE WHEN l_discount > 0.08 THEN ['discount'] ELSE [] END || CASE WHEN l_tax < 0.01 THEN ['tax'] ELSE [] END"


def line_rules() -> dict:
    return {"quantity": numbers.outside(F.col("l_quantity"), 0, 40), "discount": numbers.outside(F.col("l_discount"), None, 0.08), "tax": numbers.outside(F.col("l_tax"), 0.01, None)}


@query("SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_quantity > 40 AS quantity, l_discount > 0.08 AS discount, l_tax < 0.01 AS tax FROM lineitem")
def domain_rules(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", *[r.alias(n) for n, r in line_rules().items()])


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, array_to_string({RULE_SQL}, ', ') AS reasons FROM lineitem WHERE len({RULE_SQL}) > 0")
def reject_reasons_list(spark, d):
    _, rejected = quality.split(table(spark, d, "lineitem"), line_rules())
    return rejected.select("l_orderkey", "l_linenumber", "l_partkey", text.joined_reasons(F.col("reasons")).alias("reasons"))


@query(f"SELECT reason, count(*) AS n FROM (SELECT unnest({RULE_SQL}) AS reason FROM lineitem) GROUP BY reason")
def reject_reason_counts(spark, d):
    _, rejected = quality.split(table(spark, d, "lineitem"), line_rules())
    return quality.reason_counts(rejected)


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE len({RULE_SQL}) = 0")
def accepted_split(spark, d):
    accepted, _ = quality.split(table(spark, d, "lineitem"), line_rules())
    return accepted.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


def water_readings(spark, d) -> DataFrame:
    """Line items as water readings, some of them broken."""
    rows = table(spark, d, "lineitem")
    n = F.col("l_partkey") % 50
    return rows.select(
        F.when(n != 0, F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("id_leitura_origem"),
        F.when(n != 1, F.col("l_suppkey")).alias("id_estacao"),
        F.when(n != 2, F.col("l_shipdate").cast("timestamp")).alias("data_leitura"),
        F.when(n == 3, 60.0).otherwise(F.col("l_quantity") / 2).alias("temperatura_agua"),
        F.when(n == 4, 15.0).otherwise(F.lit(7.0)).alias("ph"),
        F.when(n == 5, -1.0).otherwise(F.col("l_tax")).alias("oxigenio"),
        F.when(n == 6, F.lit(float("inf"))).otherwise(F.col("l_extendedprice")).alias("condutividade"),
        F.when(n == 7, None).otherwise(F.col("l_discount")).alias("turbidez"),
    )


@query("""WITH r AS (SELECT l_partkey % 50 AS n FROM lineitem), c AS (SELECT count(*) AS e, count(*) FILTER (n IN (0, 1, 2, 7)) AS completeness, count(*) FILTER (n = 3) AS accuracy, count(*) FILTER (n IN (4, 5, 6)) AS validity,
count(*) FILTER (n = 2) AS timeliness, count(*) FILTER (n = 1) AS consistency FROM r),
u AS (SELECT count(*) AS e, count(DISTINCT concat(l_orderkey, '-', l_linenumber)) AS a FROM lineitem WHERE l_partkey % 50 > 7)
SELECT dimension, e AS evaluated, e - x AS approved, x AS rejected FROM (UNPIVOT c ON completeness, accuracy, validity, timeliness, consistency INTO NAME dimension VALUE x)
UNION ALL SELECT 'uniqueness', e, a, e - a FROM u""")
def quality_dimensions(spark, d):
    clean, counts = quality.assess(water_readings(spark, d), WATER)
    unique = clean.agg(F.count("*").alias("evaluated"), F.count_distinct(*WATER.key).alias("approved"))
    return quality.dimension_counts(counts).where("dimension <> 'uniqueness'").unionByName(unique.select(F.lit("uniqueness").alias("dimension"), "evaluated", "approved", (F.col("evaluated") - F.col("approved")).alias("rejected")))


@query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-08'")
def window_half_open(spark, d):
    start, end = times.exclusive_days("2024-01-01", "2024-01-08")
    return table(spark, d, "events").where(times.half_open(F.col("ts"), start, end)).select("event_id", "ts")


@query("SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-08'")
def window_inclusive_day(spark, d):
    start, end = times.inclusive_days("2024-01-01", "2024-01-08")
    return table(spark, d, "events").where(times.half_open(F.col("ts"), start, end)).select("event_id", "ts")


@query("SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) < DATE '2024-02-01' UNION ALL SELECT -count(*), TIMESTAMP '2024-01-01' FROM events WHERE CAST(ts AS DATE) <> CAST(ts + INTERVAL 6 HOUR AS DATE)")
def partition_day_guard(spark, d):
    """Rows that lie in the folder of their day pass the guard; of those in another day's, the guard says how many."""
    e = table(spark, d, "events").select("event_id", "ts")
    good = tables.checked_days(e.where(times.utc_day(F.col("ts")) < "2024-02-01").withColumn(tables.DAY, times.utc_day(F.col("ts"))), "ts")
    try:
        tables.checked_days(e.withColumn(tables.DAY, (times.in_utc(F.col("ts")) + F.expr("interval 6 hours")).cast("date")), "ts")
        outside = 0
    except ValueError as why:
        outside = int(str(why).split()[0])
    return good.drop(tables.DAY).union(spark.createDataFrame([(-outside,)], "event_id bigint").select("event_id", F.lit("2024-01-01").cast("timestamp_ntz").cast(dict(e.dtypes)["ts"])))


ORDER = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {ORDER}) = 1")
def dedup_keep_first(spark, d):
    return keys.keep_first(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ORDER.split(", ")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows, count(DISTINCT (l_partkey, l_suppkey)) AS n_versions FROM lineitem GROUP BY ALL HAVING count(DISTINCT (l_partkey, l_suppkey)) > 1")
def conflicting_replays(spark, d):
    return keys.conflicting_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"])


def some_suppliers(spark, d) -> DataFrame:
    """Stations of which a third are not registered."""
    return table(spark, d, "supplier").where("s_suppkey % 3 <> 0")


@query("SELECT l_orderkey, l_linenumber, l_partkey, s_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey AND s_suppkey % 3 <> 0")
def lookup_left_m1(spark, d):
    dim = some_suppliers(spark, d).select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    found, _ = joins.lookup(table(spark, d, "lineitem"), dim, ["l_suppkey"])
    return found.select("l_orderkey", "l_linenumber", "l_partkey", "s_name")


@query("SELECT l_suppkey, count(*) AS n FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_suppkey % 3 <> 0) GROUP BY l_suppkey")
def lookup_unmatched(spark, d):
    dim = some_suppliers(spark, d).select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    _, unmatched = joins.lookup(table(spark, d, "lineitem"), dim, ["l_suppkey"])
    return unmatched.groupBy("l_suppkey").agg(F.count("*").alias("n"))


@query("SELECT s_suppkey, n_nationkey FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey")
def composite_key_join(spark, d):
    """Suppliers find their nation by its name and region as they would write it: in other case, with accents."""
    n, r = table(spark, d, "nation"), table(spark, d, "region")
    places = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", F.col("n_name").alias("place"), F.col("r_name").alias("state"))
    written = places.select("n_nationkey", F.concat(F.lit(" "), F.translate(F.lower("place"), "ae", "áé")).alias("city"), F.lower("state").alias("uf")).withColumnRenamed("n_nationkey", "_n")
    s = table(spark, d, "supplier").join(written, F.col("s_nationkey") == F.col("_n"), "left").drop("_n")
    return joins.match_places(s, places, "city", "uf").select("s_suppkey", "n_nationkey")


@query("SELECT s_suppkey, s_name, n_name, r_name FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey")
def snowflake_enrich(spark, d):
    s, n, r = (table(spark, d, x) for x in ("supplier", "nation", "region"))
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left").select("s_suppkey", "s_name", "n_name", "r_name")


@query("SELECT k AS l_suppkey, s_name FROM (SELECT DISTINCT l_suppkey AS k FROM lineitem) LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 3 <> 0) ON s_suppkey = k")
def reindex_keys(spark, d):
    dim = some_suppliers(spark, d).select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    return joins.reindex(table(spark, d, "lineitem"), dim, ["l_suppkey"]).select("l_suppkey", "s_name")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def anti_join_new_keys(spark, d):
    known = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.new_rows(table(spark, d, "orders"), known, ["o_orderkey"]).select("o_orderkey", "o_custkey")


@query("SELECT c_custkey FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 250000)")
def not_exists(spark, d):
    return spark.sql("SELECT c_custkey FROM {c} c WHERE NOT EXISTS (SELECT 1 FROM {o} o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 250000)", c=table(spark, d, "customer"), o=table(spark, d, "orders"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 49)")
def semi_join_collision(spark, d):
    hit = table(spark, d, "lineitem").where("l_quantity > 49").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.known_rows(table(spark, d, "orders"), hit, ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query("SELECT count(*) AS n FROM lineitem LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0) ON s_suppkey = l_suppkey WHERE s_suppkey IS NULL")
def orphan_check(spark, d):
    return joins.orphans(table(spark, d, "lineitem"), some_suppliers(spark, d), {"l_suppkey": "s_suppkey"}).agg(F.count("*").alias("n"))


@query("SELECT 'city' AS kind, CAST(n_nationkey AS BIGINT) AS id FROM nation WHERE n_nationkey % 5 <> 0 UNION ALL SELECT 'station', CAST(s_suppkey AS BIGINT) FROM supplier WHERE s_nationkey % 5 <> 0")
def cascade_delete(spark, d):
    n = table(spark, d, "nation")
    kept, children = joins.delete_with_children(n, table(spark, d, "supplier"), n.where("n_nationkey % 5 = 0"), "n_nationkey", "s_nationkey")
    return kept.select(F.lit("city").alias("kind"), F.col("n_nationkey").cast("bigint").alias("id")).union(children.select(F.lit("station"), F.col("s_suppkey").cast("bigint")))


def codes_of(spark, d) -> dict[str, str]:
    """The five parameters of the reports: line items' numeric columns and quantity by flag."""
    return {"l_quantity": "avg_quantity", "l_extendedprice": "avg_price", "l_discount": "avg_discount", "l_tax": "avg_tax"}


@query(f"SELECT s_suppkey, round(avg(valor) FILTER (codigo_parametro = 'l_quantity'), 7) AS avg_quantity, round(avg(valor) FILTER (codigo_parametro = 'l_extendedprice'), 3) AS avg_price, round(avg(valor) FILTER (codigo_parametro = 'l_discount'), 7) AS avg_discount, round(avg(valor) FILTER (codigo_parametro = 'l_tax'), 7) AS avg_tax FROM supplier LEFT JOIN ({LONG}) ON id_estacao = s_suppkey GROUP BY s_suppkey")
def eav_pivot_avg(spark, d):
    measures = line_measures(spark, d).select("id_estacao", F.col("codigo_parametro").alias("code"), F.col("valor").alias("value"))
    s = table(spark, d, "supplier").select("s_suppkey")
    rows = s.join(measures, s.s_suppkey == measures.id_estacao, "left").groupBy("s_suppkey").agg(*reshape.conditional(F.avg, codes_of(spark, d)))
    return rounded(rounded(rows, "avg_quantity", "avg_discount", "avg_tax"), "avg_price", places=3)


@query("SELECT user_id, CAST(ts AS DATE) AS day, count(DISTINCT event_id) AS events, round(avg(value) FILTER (event_type = 'click'), 7) AS avg_click, round(avg(value) FILTER (event_type = 'view'), 7) AS avg_view FROM events GROUP BY ALL")
def eav_daily_evolution(spark, d):
    e = table(spark, d, "events").select("event_id", "user_id", times.utc_day(F.col("ts")).alias("day"), F.col("event_type").alias("code"), "value")
    rows = e.groupBy("user_id", "day").agg(F.count_distinct("event_id").alias("events"), *reshape.conditional(F.avg, {"click": "avg_click", "view": "avg_view"}))
    return rounded(rows, "avg_click", "avg_view")


@query("SELECT o_orderkey, max(l_quantity) AS quantity, max(l_discount) AS discount FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey")
def eav_event_row(spark, d):
    headers = table(spark, d, "orders").select("o_orderkey")
    rows = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"))
    found = reshape.items(rows, ["o_orderkey"], ["quantity", "discount"])
    return reshape.event_rows(headers, found, ["o_orderkey"], ["quantity", "discount"])


@query("SELECT n_name, r_name, count(DISTINCT l_orderkey) AS events, round(avg(l_quantity), 7) AS avg_quantity, round(sum(l_tax), 3) AS sum_tax FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL")
def eav_city_sum(spark, d):
    l, s, n, r = (table(spark, d, x) for x in ("lineitem", "supplier", "nation", "region"))
    rows = l.join(s, l.l_suppkey == s.s_suppkey).join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    found = rows.groupBy("n_name", "r_name").agg(F.count_distinct("l_orderkey").alias("events"), F.avg("l_quantity").alias("avg_quantity"), F.sum("l_tax").alias("sum_tax"))
    return rounded(rounded(found, "avg_quantity"), "sum_tax", places=3)


@query("SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT event_id) AS events FROM events GROUP BY event_type")
def count_distinct_events(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count_distinct("event_id").alias("events"))


@query("SELECT count(DISTINCT l_suppkey) AS stations, round(avg(l_quantity), 7) AS avg_quantity, round(avg(l_discount), 7) AS avg_discount FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey = 1 AND l_shipdate >= TIMESTAMP '1995-01-01'")
def bi_measures(spark, d):
    l, s, n = (table(spark, d, x) for x in ("lineitem", "supplier", "nation"))
    rows = l.where("l_shipdate >= timestamp '1995-01-01'").join(s, l.l_suppkey == s.s_suppkey).join(n.where("n_regionkey = 1"), s.s_nationkey == n.n_nationkey)
    return rounded(rows.agg(F.count_distinct("l_suppkey").alias("stations"), F.avg("l_quantity").alias("avg_quantity"), F.avg("l_discount").alias("avg_discount")), "avg_quantity", "avg_discount")


@query("SELECT l_orderkey, l_linenumber, l_partkey, code, value FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME code VALUE value)")
def unpivot_long(spark, d):
    return reshape.items(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], ["l_quantity", "l_discount", "l_tax"])


@query("SELECT * FROM (SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, CAST(NULL AS DOUBLE), c_mktsegment FROM customer)")
def union_schema_evolution(spark, d):
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return s.unionByName(c, allowMissingColumns=True)


@query("SELECT DISTINCT l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS day FROM lineitem")
def set_distinct(spark, d):
    return table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", times.utc_day(F.col("l_shipdate")).alias("day")).distinct()


@query("SELECT s_nationkey AS k FROM supplier EXCEPT SELECT c_nationkey FROM customer WHERE c_custkey % 97 = 0")
def set_except(spark, d):
    return table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")).subtract(table(spark, d, "customer").where("c_custkey % 97 = 0").select("c_nationkey"))


@query("SELECT s_nationkey AS k FROM supplier INTERSECT SELECT c_nationkey FROM customer WHERE c_custkey % 3 = 0")
def set_intersect(spark, d):
    return table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")).intersect(table(spark, d, "customer").where("c_custkey % 3 = 0").select("c_nationkey"))


@query("SELECT row_number() OVER (ORDER BY data) AS sk_tempo, data, CAST(year(data) AS INTEGER) AS ano, CAST(month(data) AS INTEGER) AS mes, CAST(day(data) AS INTEGER) AS dia, CAST(quarter(data) AS INTEGER) AS trimestre, CAST(isodow(data) - 1 AS INTEGER) AS dia_semana, isodow(data) < 6 AS dia_util FROM (SELECT DISTINCT CAST(ts AS DATE) AS data FROM events)")
def dim_time(spark, d):
    return star.dim_time(event_measures(spark, d))


@query("SELECT row_number() OVER (ORDER BY c) AS sk_parametro, c AS codigo_parametro, c AS nome_parametro, 'desconhecida' AS unidade_medida FROM (SELECT DISTINCT event_type AS c FROM events)")
def dim_parameter(spark, d):
    return star.dim_parameter(event_measures(spark, d))


def registers(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Suppliers, nations and regions as the registers of stations, cities and states."""
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id_estacao"), F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("codigo_origem"), F.col("s_name").alias("nome_estacao"), (F.col("s_acctbal") > 0).cast("int").alias("status_estacao"), F.col("s_nationkey").cast("bigint").alias("id_cidade"))
    n = table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("id_cidade"), F.col("n_regionkey").cast("bigint").alias("id_estado"), F.col("n_nationkey").cast("bigint").alias("codigo_ibge_cidade"), F.col("n_name").alias("nome_cidade"))
    r = table(spark, d, "region").select(F.col("r_regionkey").cast("bigint").alias("id_estado"), F.substring("r_name", 1, 2).alias("sigla_estado"), F.col("r_name").alias("nome_estado"))
    return s, n, r


@query("SELECT row_number() OVER (ORDER BY u) AS sk_estacao, u AS id_estacao, s_name AS nome_estacao, n_name AS nome_cidade, r_name AS nome_estado FROM (SELECT DISTINCT user_id AS u FROM events) LEFT JOIN supplier ON s_suppkey = u LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey")
def dim_station(spark, d):
    return star.dim_station(event_measures(spark, d), *registers(spark, d)).select("sk_estacao", "id_estacao", "nome_estacao", "nome_cidade", "nome_estado")


@query(f"""{Z}, {IQR}, t AS (SELECT data, row_number() OVER (ORDER BY data) AS sk_tempo FROM (SELECT DISTINCT CAST(ts AS DATE) AS data FROM events)),
u AS (SELECT k, row_number() OVER (ORDER BY k) AS sk_estacao FROM (SELECT DISTINCT user_id AS k FROM events)), p AS (SELECT k, row_number() OVER (ORDER BY k) AS sk_parametro FROM (SELECT DISTINCT event_type AS k FROM events))
SELECT sk_estacao, sk_tempo, sk_parametro, CAST(i.event_id AS VARCHAR) AS id_leitura_origem, i.value AS valor_lido,
round(avg(i.value) OVER (PARTITION BY i.user_id, i.event_type ORDER BY ts, CAST(i.event_id AS VARCHAR) ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 7) AS media_movel,
flag AS anomalia_iqr, CASE WHEN status = 'avaliado' THEN abs((i.value - m) / s) > 3 END AS anomalia_zscore, coalesce(flag, false) OR coalesce(CASE WHEN status = 'avaliado' THEN abs((i.value - m) / s) > 3 END, false) AS alerta_qualidade
FROM i JOIN z USING (event_id) JOIN t ON t.data = CAST(i.ts AS DATE) JOIN u ON u.k = i.user_id JOIN p ON p.k = i.event_type""")
def fact_star(spark, d):
    fact = star.star_schema(event_measures(spark, d), *registers(spark, d))["Fato_Medicoes"]
    return rounded(fact, "media_movel").drop("dataset", "data_leitura")


@query("SELECT CAST(c_custkey AS VARCHAR) AS id_leitura_origem, CASE WHEN c_custkey % 2 = 0 THEN 20.0 ELSE 30.0 END AS temperatura_agua FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def upsert_insert_ignore(spark, d):
    """Readings merged into a table by day, then others of which some have keys that are there: those stay as they were."""
    folder = scratch(spark, "merge")
    c = table(spark, d, "customer")
    for mod, value in ((2, 20.0), (3, 30.0)):
        tables.merge(customer_readings(c.where(F.col("c_custkey") % mod == 0), value, day=F.col("c_custkey") % (5 * mod)), WATER, folder)
    return tables.read_table(spark, f"{folder}/{WATER.name}").select("id_leitura_origem", "temperatura_agua")


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'insert' WHEN o_orderkey % 5 = 1 THEN 'reject' WHEN o_orderkey % 5 = 2 THEN 'enrich' ELSE 'replay' END AS verdict FROM orders""")
def upsert_enrich(spark, d):
    """Headers against stored ones: new, with another station, with an operator that the stored one lacks, or the same."""
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("station"), F.col("o_orderpriority").alias("operator"))
    n = F.col("id") % 5
    stored = rows.where(n != 0).select("id", F.when(n == 1, F.col("station") + 1).otherwise(F.col("station")).alias("station"), F.when(n != 2, F.col("operator")).alias("operator"))
    return upsert.classify(rows, stored, ["id"], ["station"], ["operator"]).select("id", "verdict")


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 1 THEN c_acctbal + 1 ELSE c_acctbal END AS balance, c_mktsegment AS segment, CASE c_custkey % 4 WHEN 0 THEN 'insert' WHEN 1 THEN 'update' ELSE 'replay' END AS verdict FROM customer""")
def upsert_update_changed(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    n = F.col("id") % 4
    new = rows.where(n != 3).select("id", F.when(n == 1, F.col("balance") + 1).otherwise(F.col("balance")).alias("balance"), F.when(n != 2, F.col("segment")).alias("segment"))
    return upsert.upsert(new, rows.where(n != 0), ["id"], ["balance", "segment"], keep_if_null=["segment"])


@query("SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS codes FROM events GROUP BY user_id")
def event_code_set(spark, d):
    return upsert.code_sets(table(spark, d, "events"), ["user_id"], "event_type")


@query("SELECT k AS l_orderkey, CASE WHEN k % 3 = 0 THEN 'insert' WHEN k % 3 = 1 THEN 'reject' ELSE 'replay' END AS verdict FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem)")
def event_verdicts(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", F.concat_ws("/", "l_linenumber", "l_partkey", "l_suppkey").alias("code"), F.col("l_quantity").alias("value"))
    n = F.col("l_orderkey") % 3
    stored = rows.where(n != 0).withColumn("value", F.when(n == 1, F.col("value") + 1).otherwise(F.col("value")))
    return upsert.event_verdicts(rows, stored, ["l_orderkey"])


@query("SELECT 'missing' AS side, l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber FROM lineitem EXCEPT ALL SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) UNION ALL SELECT 'extra', l_orderkey, l_linenumber FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem EXCEPT ALL SELECT l_orderkey, l_linenumber FROM lineitem)")
def reconcile_except_all(spark, d):
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber")
    a, b = upsert.differences(rows, rows.distinct())
    return a.select(F.lit("missing").alias("side"), "*").unionByName(b.select(F.lit("extra").alias("side"), "*"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN CAST(CAST(p_retailprice AS DECIMAL(18,6)) AS DOUBLE) END AS exact FROM part")
def decimal_domain(spark, d):
    """Prices in text, every third with more places than fit."""
    written = F.concat(F.format_string("%.2f", "p_retailprice"), F.when(F.col("p_partkey") % 3 == 0, "00001").otherwise("00"))
    return table(spark, d, "part").select("p_partkey", numbers.exact_decimal(written).cast("double").alias("exact"))


@query("SELECT code, count(*) AS n FROM (SELECT CASE event_id % 6 WHEN 0 THEN 'no value' WHEN 1 THEN 'two values' WHEN 2 THEN 'not an exact number' WHEN 3 THEN 'out of range' WHEN 4 THEN 'blank text' ELSE '' END AS code FROM events) GROUP BY code")
def item_rules(spark, d):
    i = F.col("event_id") % 6
    number = F.when(i.isin(1, 5), "7.5").when(i == 2, "0.1234567").when(i == 3, "14.01")
    words = F.when(i == 1, "x").when(i == 4, "  ")
    found = upsert.item_reasons(F.lit("PH"), number, words, {"PH": (0.0, 14.0)})
    return table(spark, d, "events").select(F.array_join(found, ",").alias("code")).groupBy("code").agg(F.count("*").alias("n"))


@query("SELECT event_id, concat(CAST(user_id AS VARCHAR), '|', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '+00:00') AS key FROM events")
def natural_key_string(spark, d):
    return table(spark, d, "events").select("event_id", times.natural_key(F.col("user_id"), F.col("ts")).alias("key"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS id_leitura_origem, CAST(c_custkey % 10 AS BIGINT) AS day, 20.0 AS temperatura_agua FROM customer WHERE c_custkey % 10 NOT IN (2, 3, 4) UNION ALL SELECT 'new-' || c_custkey, CAST(2 AS BIGINT), 25.0 FROM customer WHERE c_custkey % 10 = 2")
def rebuild_days(spark, d):
    """A table of ten days of which three are replaced by a reference that has rows for one of them alone."""
    from datetime import datetime, timezone

    folder, c = scratch(spark, "rebuild"), table(spark, d, "customer")
    tables.merge(customer_readings(c, 20.0, day=F.col("c_custkey") % 10), WATER, folder)
    new = customer_readings(c.where("c_custkey % 10 = 2"), 25.0, day=F.col("c_custkey") % 10).withColumn("id_leitura_origem", F.concat(F.lit("new-"), "id_leitura_origem"))
    tables.rebuild(lambda: new, WATER, folder, *(datetime(2026, 1, day, tzinfo=timezone.utc) for day in (3, 6)))
    return tables.read_table(spark, f"{folder}/{WATER.name}").select("id_leitura_origem", (F.dayofmonth(tables.DAY) - 1).cast("bigint").alias("day"), "temperatura_agua")


@query("""SELECT count(*) AS received, count(*) FILTER (c_acctbal <= 5000) AS written, (SELECT count(DISTINCT c_custkey % 7) FROM customer WHERE c_acctbal <= 5000) AS days, count(*) FILTER (c_acctbal > 5000) AS out_of_range FROM customer""")
def manifest_counts(spark, d):
    """What the manifest of a merge says of readings that are too warm at large balances."""
    folder = scratch(spark, "manifest")
    rows = customer_readings(table(spark, d, "customer"), F.when(F.col("c_acctbal") > 5000, 99.0).otherwise(20.0), day=F.col("c_custkey") % 7)
    done = tables.merge(rows, WATER, folder)
    m = spark.read.option("multiLine", "true").json(done.manifest)
    return m.select(F.col("linhas_recebidas").alias("received"), F.col("linhas_gravadas").alias("written"), F.size("particoes_gravadas").cast("bigint").alias("days"), F.col("dimensoes_qualidade.accuracy.linhas_rejeitadas").alias("out_of_range"))


_CPF = "list_transform(range(1, 10), lambda i: CAST(s[i] AS INTEGER))"


@query(f"""WITH b AS (SELECT c_custkey, lpad(CAST(c_custkey * 7919 AS VARCHAR), 9, '0') AS s FROM customer),
one AS (SELECT *, list_sum(list_transform({_CPF}, lambda x, i: x * (11 - i))) * 10 % 11 % 10 AS d1 FROM b),
two AS (SELECT *, (list_sum(list_transform({_CPF}, lambda x, i: x * (12 - i))) + 2 * d1) * 10 % 11 % 10 AS d2 FROM one)
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 AND s <> '000000000' THEN s || CAST(CAST(d1 AS BIGINT) AS VARCHAR) || CAST(CAST(d2 AS BIGINT) AS VARCHAR) END AS cpf FROM two""")
def cpf_check_digits(spark, d):
    """Numbers made from ids with their right check digits, every second with a wrong one."""
    base = F.lpad((F.col("c_custkey") * 7919).cast("string"), 9, "0")
    digit = [F.substring(base, i + 1, 1).cast("int") for i in range(9)]
    one = sum((x * (10 - i) for i, x in enumerate(digit[1:], 1)), digit[0] * 10) * 10 % 11 % 10
    two = (sum((x * (11 - i) for i, x in enumerate(digit[1:], 1)), digit[0] * 11) + one * 2) * 10 % 11 % 10
    written = F.concat(F.substring(base, 1, 3), F.lit("."), F.substring(base, 4, 6), F.lit("-"), one.cast("string"), F.when(F.col("c_custkey") % 2 == 0, two).otherwise((two + 1) % 10).cast("string"))
    return table(spark, d, "customer").select("c_custkey", personal.cpf_digits(written).alias("cpf"))


_KEY = b"a key for tests alone"
_PADS = ["".join(f"{x ^ p:02x}" for x in _KEY.ljust(64, b"\0")) for p in (0x36, 0x5C)]


@query(f"SELECT c_custkey, sha256(unhex('{_PADS[1]}') || unhex(sha256(unhex('{_PADS[0]}') || encode(c_name)))) AS pseudonym FROM customer")
def hmac_pseudonym(spark, d):
    return table(spark, d, "customer").select("c_custkey", personal.hmac_sha256(F.col("c_name"), _KEY).alias("pseudonym"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS s_name, s_suppkey % 4 <> 0 AS authentic, 'gAAAA' AS head, CAST(((len(s_name) // 16 + 1) * 16 + 57 + 2) // 3 * 4 AS INTEGER) AS length FROM supplier")
def encrypted_names(spark, d):
    """Names encrypted and read again by an authorised principal, every fourth token changed; a token's first bytes and length are those of its format."""
    key = "MDEyMzQ1Njc4OTAxMjM0NTY3ODkwMTIzNDU2Nzg5MDE="
    rows = table(spark, d, "supplier").select("s_suppkey", personal.encrypt_name(F.col("s_name"), key, at=F.lit(1_700_000_000).cast("bigint")).alias("token"))
    other = F.concat(F.substring("token", 1, 40), F.when(F.substring("token", 41, 1) == "A", "B").otherwise("A"), F.expr("substring(token, 42)"))
    rows = rows.withColumn("token", F.when(F.col("s_suppkey") % 4 == 0, other).otherwise(F.col("token")))
    name = personal.read_names(F.col("token"), key, principal="loader", authorize=lambda who, what: who == "loader")
    return rows.select("s_suppkey", name.alias("s_name"), name.isNotNull().alias("authentic"), F.substring("token", 1, 5).alias("head"), F.length("token").alias("length"))


@query("SELECT CAST(p AS BIGINT) AS place, line FROM (SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS p, concat_ws(';', o_orderkey, o_custkey, CASE WHEN o_orderkey % 2 = 0 THEN 'True' ELSE 'False' END, coalesce(CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END, ''), strftime(CAST(o_orderdate AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') || '+00:00') AS line FROM orders)")
def sorted_publish(spark, d):
    """Orders published as one CSV file and read again line by line."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", (F.col("o_orderkey") % 2 == 0).alias("even"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("priority"), F.col("o_orderdate").cast("timestamp_ntz").alias("at"))
    path = f"{scratch(spark, 'report')}/orders.csv"
    tables.write_csv(o, path, ["at", "o_orderkey"])
    return tables.numbered_lines(spark, path).where("place > 0 and line <> ''")


@query("SELECT CAST(event_id AS VARCHAR) AS id_leitura_origem, round(value, 7) AS valor FROM events ORDER BY value DESC, CAST(event_id AS VARCHAR) LIMIT 20")
def top_anomalies(spark, d):
    return rounded(event_measures(spark, d).orderBy(F.desc("valor"), "id_leitura_origem").limit(20), "valor").select("id_leitura_origem", "valor")


@query("SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY ALL")
def stream_dedup_available_now(spark, d):
    """Line items streamed into a table of first rows by key, twice; the second time adds nothing."""
    from ..streaming.ingest import dedup_stream

    root = scratch(spark, "stream")
    rows = spark.read.parquet(f"{d}/lineitem.parquet")
    for turn in range(2):
        stream = spark.readStream.schema(rows.schema).option("pathGlobFilter", "lineitem.parquet").parquet(d).select("l_orderkey", "l_linenumber", "l_partkey")
        dedup_stream(stream, ["l_orderkey", "l_linenumber"], f"{root}/table", f"{root}/checkpoint{turn}", ["l_partkey"]).awaitTermination()
    return spark.read.parquet(f"{root}/table")


@query("""SELECT 'unique: l_orderkey, l_linenumber' AS "constraint", count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS broken FROM lineitem
UNION ALL SELECT 'references: l_suppkey', count(*) FILTER (l_suppkey % 3 = 0 OR l_suppkey NOT IN (SELECT s_suppkey FROM supplier)) FROM lineitem
UNION ALL SELECT 'not null: l_partkey', count(*) FILTER (l_partkey IS NULL) FROM lineitem UNION ALL SELECT 'check: quantity', count(*) FILTER (NOT l_quantity <= 40) FROM lineitem""")
def constraint_report(spark, d):
    rules = [constraints.Unique(("l_orderkey", "l_linenumber")), constraints.References({"l_suppkey": "s_suppkey"}, some_suppliers(spark, d)), constraints.NotNull(("l_partkey",)), constraints.Check("quantity", F.col("l_quantity") <= 40)]
    return constraints.report(table(spark, d, "lineitem"), rules)


def order_events(spark, d) -> tuple[DataFrame, DataFrame]:
    """(batch, stored) of orders as water readings.

    By the key modulo 6: new and twice the same; stored; stored with another value; stored without the operator;
    new, then again with another value; stored, but its items were lost.
    """
    n = F.col("o_orderkey") % 6
    rows = table(spark, d, "orders").select(F.lit(0).alias("turn"), F.col("o_orderkey"), F.col("o_orderkey").cast("string").alias("id_leitura_origem"), F.col("o_custkey").alias("id_estacao"), F.when(n == 3, 1).cast("bigint").alias("id_operador"), F.col("o_orderdate").cast("timestamp").alias("data_leitura"), F.lit("20.5").alias("temperatura_agua"), F.lit("7").alias("ph"), *[F.lit(None).cast("string").alias(c) for c in ("oxigenio", "condutividade", "turbidez")])
    again = rows.where(n.isin(0, 4)).withColumn("turn", F.lit(1)).withColumn("ph", F.when(n == 4, "9").otherwise(F.col("ph")))
    old = rows.where(~n.isin(0, 4)).withColumn("id_operador", F.lit(None).cast("bigint")).withColumn("ph", F.when(n == 2, "8").otherwise(F.col("ph")))
    return rows.unionByName(again), old


def loaded_orders(spark, d) -> tuple[relational.Persisted, DataFrame, DataFrame]:
    """What loading the batch did, and both tables after it: the stored orders were loaded before, and some of their items lost."""
    batch, old = order_events(spark, d)
    folder = scratch(spark, "orders")
    relational.persist(relational.prepare(old, WATER), folder)
    with versions.leased(spark, folder) as lease:
        seen = versions.current(spark, folder)
        lost = f"leitura_itens/{versions.new_folder()}"
        relational.stored(spark, folder)[1].where(F.col("chave_origem").cast("bigint") % 6 != 5).write.parquet(f"{folder}/{lost}")
        versions.publish(spark, folder, seen, seen.content | {"items": [{"folder": lost, "rows": 0}]}, lease)
    return relational.persist(relational.prepare(batch, WATER, ["turn"]), folder), *relational.stored(spark, folder)


@query("""SELECT verdict, count(*) AS n FROM (SELECT CASE o_orderkey % 6 WHEN 0 THEN 'insert' WHEN 1 THEN 'replay' WHEN 2 THEN 'reject' WHEN 3 THEN 'enrich' WHEN 4 THEN 'insert' ELSE 'repair' END AS verdict FROM orders
UNION ALL SELECT CASE o_orderkey % 6 WHEN 0 THEN 'replay' ELSE 'reject' END FROM orders WHERE o_orderkey % 6 IN (0, 4)) GROUP BY verdict""")
def event_load(spark, d):
    """Orders loaded beside stored ones: how many rows have each verdict."""
    return loaded_orders(spark, d)[0].verdicts.groupBy("verdict").agg(F.sum("n").alias("n"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS chave_origem, code AS codigo_parametro, CASE WHEN code = 'TEMP_AGUA' THEN 20.5 WHEN o_orderkey % 6 = 2 THEN 8.0 ELSE 7.0 END AS valor FROM orders, (VALUES ('TEMP_AGUA'), ('PH')) x(code)")
def event_load_items(spark, d):
    """The items after the same load, of which it added those of new events and those that were lost."""
    return loaded_orders(spark, d)[2].select("chave_origem", "codigo_parametro", F.col("valor_numerico").cast("double").alias("valor"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS chave_origem, CAST(o_custkey AS BIGINT) AS id_estacao, CASE WHEN o_orderkey % 6 = 3 THEN CAST(1 AS BIGINT) END AS id_operador, CAST(o_orderdate AS DATE) AS day FROM orders")
def event_load_headers(spark, d):
    """The headers after the same load, of which it added the new ones and some operators."""
    return loaded_orders(spark, d)[1].select("chave_origem", "id_estacao", "id_operador", times.utc_day(F.col("data_leitura")).alias("day"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS chave_origem, code AS codigo_parametro, CASE code WHEN 'TEMP_AGUA' THEN 20.0 ELSE 7.0 END AS valor FROM customer, (VALUES ('TEMP_AGUA'), ('PH')) x(code)")
def migration_reconcile(spark, d):
    """Customers as an old wide table, migrated and reconciled; the items of its tables."""
    folder, c = scratch(spark, "migration"), table(spark, d, "customer")
    old = customer_readings(c, 20.0, day=F.col("c_custkey") % 3).withColumns({x: F.lit(None).cast("double") for x in ("oxigenio", "condutividade", "turbidez")})
    relational.migrate({WATER.name: old}, folder, c.select(F.col("c_nationkey").cast("bigint").alias("id_estacao")).distinct())
    return relational.stored(spark, folder)[1].select("chave_origem", "codigo_parametro", F.col("valor_numerico").cast("double").alias("valor"))


@query("SELECT CAST(o_orderkey AS VARCHAR) AS id_leitura_origem, list_sort(CASE WHEN o_orderkey % 4 = 0 THEN ['temperatura_agua: out of range'] ELSE [] END || CASE WHEN o_orderkey % 6 = 0 THEN ['id_estacao: missing'] ELSE [] END || CASE WHEN o_orderkey % 9 = 0 THEN ['ph: missing or no number'] ELSE [] END).array_to_string(', ') AS reasons FROM orders WHERE o_orderkey % 4 = 0 OR o_orderkey % 6 = 0 OR o_orderkey % 9 = 0")
def rejected_rows(spark, d):
    """Rows that the flow's rules reject, with all their reasons."""
    k = F.col("o_orderkey")
    rows = table(spark, d, "orders").select(k.cast("string").alias("id_leitura_origem"), F.when(k % 6 != 0, F.col("o_custkey")).alias("id_estacao"), F.when(k % 4 == 0, 51.0).otherwise(50.0).alias("temperatura_agua"), F.when(k % 9 != 0, 7.0).alias("ph"), *[F.lit(1.0).alias(c) for c in ("oxigenio", "condutividade", "turbidez")])
    _, rejected = quality.split(rows, quality.row_rules(WATER, ["id_leitura_origem", "id_estacao", *WATER.numeric]))
    return rejected.select("id_leitura_origem", F.array_join(F.array_sort("reasons"), ", ").alias("reasons"))


@query("SELECT event_id, user_id FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-03' AND CAST(ts AS DATE) < DATE '2024-01-05'")
def read_days_pruned(spark, d):
    """Two days of a table by day, of which the other folders are not read."""
    path = f"{scratch(spark, 'days')}/events"
    e = table(spark, d, "events").select("event_id", "user_id", "ts").withColumn(tables.DAY, times.utc_day(F.col("ts")))
    e.repartitionByRange(tables.DAY).write.partitionBy(tables.DAY).parquet(path)
    from datetime import date

    return tables.read_days(spark, path, date(2024, 1, 3), date(2024, 1, 5)).select("event_id", "user_id")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 0 WHEN c_custkey % 3 = 1 THEN 1 END AS position, 'r' || c_custkey AS id FROM customer WHERE c_custkey % 3 < 2 UNION ALL SELECT c_custkey, 0, 's' || c_custkey FROM customer WHERE c_custkey % 3 = 1 UNION ALL SELECT c_custkey, 0, 't' || c_custkey FROM customer WHERE c_custkey % 3 = 2")
def raw_envelopes(spark, d):
    """Records of payloads that are a list of two, an envelope of one, or one record."""
    k, n = F.col("c_custkey").cast("string"), F.col("c_custkey") % 3
    one = lambda letter: F.concat(F.lit('{"id":"' + letter), k, F.lit('"}'))
    body = F.when(n == 0, F.concat(F.lit('{"leituras_ambientais":['), one("r"), F.lit("]}"))).when(n == 1, F.concat(F.lit("["), one("s"), F.lit(","), one("r"), F.lit("]"))).otherwise(one("t"))
    found = raw.records(table(spark, d, "customer").select("c_custkey", body.alias("body")), "qualidade_agua")
    return found.select("c_custkey", "position", F.try_variant_get("record", "$.id", "string").alias("id"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'uf: not two letters' WHEN 1 THEN 'id_estacao: not a number' WHEN 2 THEN 'dados_climaticos: a day breaks its contract' ELSE '' END AS reasons FROM orders")
def collector_contract(spark, d):
    k, n = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 4
    uf, station, day = F.when(n == 0, '"S1"').otherwise('"SP"'), F.when(n == 1, '"7"').otherwise("7"), F.when(n == 2, '"2026-02-30"').otherwise('"2026-02-28"')
    text_of = F.concat(F.lit('{"uf":'), uf, F.lit(',"id_municipio":"'), k, F.lit('","id_estacao":'), station, F.lit(',"capturado_em":"2026-01-01T00:00:00Z","detalhes_estacao":{},"dados_climaticos":[{"data":'), day, F.lit(',"temperatura_minima":1.5}]}'))
    rows = table(spark, d, "orders").select("o_orderkey", F.try_parse_json(text_of).alias("result"))
    return rows.select("o_orderkey", F.array_join(collector.result_reasons(), ",").alias("reasons"))


@query("SELECT CAST(ts AS DATE) AS dia, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_daily_counts(spark, d):
    """Events streamed into counts by day and type."""
    import uuid

    from ..streaming.ingest import daily_counts

    name = f"days_{uuid.uuid4().hex}"
    rows = table(spark, d, "events")
    stream = spark.readStream.schema(rows.schema).option("pathGlobFilter", "events.parquet").parquet(d).withColumn("ts", F.col("ts").cast("timestamp"))
    daily_counts(stream, "ts", ["event_type"]).writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).option("checkpointLocation", scratch(spark, "counts")).start().awaitTermination()
    return spark.table(name)


def queries() -> dict[str, Query]:
    from . import flow_queries  # noqa: F401  adds its own

    return {name: f for name, (f, _) in CATALOGUE.items()}


def oracle_sql() -> dict[str, str]:
    from . import flow_queries  # noqa: F401

    return {name: sql for name, (_, sql) in CATALOGUE.items() if sql}
