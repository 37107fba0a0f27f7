import http.server
import inspect
import json
import threading
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from envlake.domain import WATER, WEATHER
from envlake.plans import collector, relational
from envlake.sources import raw
from envlake.sources.files import exists
from envlake.sources.versions import clean, current

AT = datetime(2026, 5, 20, 10)
WATER_SCHEMA = "id_leitura_origem string, id_estacao bigint, id_operador bigint, data_leitura timestamp, temperatura_agua string, ph string, oxigenio string, condutividade string, turbidez string"


def water(spark, *rows):
    return relational.prepare(spark.createDataFrame(rows, WATER_SCHEMA), WATER)


def test_events_are_accepted_or_rejected_as_a_whole(spark, tmp_path):
    folder = str(tmp_path)
    first = [("a", 1, None, AT, "20", "7", None, None, None), ("b", 1, 5, AT, "20.5", "7.123456", "1", "2", "3"), ("bad", 1, None, AT, "20", "14.5", None, None, None), ("fine", None, None, AT, "1", None, None, None, None), ("none", 1, None, AT, None, None, None, None, None), ("long", 1, None, AT, "0.30000000000000004", None, None, None, None)]
    assert relational.persist_events(water(spark, *first), folder) == {"insert": 2, "reject": 4}
    again = [("a", 1, 9, AT, "20.000000", "7", None, None, None), ("b", 1, 6, AT, "20.5", "7.123456", "1", "2", "3"), ("c", 2, None, AT, "1", None, None, None, None)]
    assert relational.persist_events(water(spark, *again), folder) == {"enrich": 1, "reject": 1, "insert": 1}
    changed = [("c", 2, None, AT, "1", "7", None, None, None), ("a", 1, None, AT, "20", "7", None, None, None), ("b", 1, None, AT, "20.5", "7", "1", "2", "3")]
    assert relational.persist_events(water(spark, *changed), folder) == {"reject": 2, "replay": 1}
    headers, items = relational.stored(spark, folder)
    assert {(r.chave_origem, r.id_operador) for r in headers.collect()} == {("a", 9), ("b", 5), ("c", None)} and items.count() == 8
    wide = relational.measures_of_period(headers, items, WATER, AT, datetime(2026, 5, 21)).orderBy("chave_origem").collect()
    assert [(r.chave_origem, float(r.temperatura_agua), r.oxigenio is None) for r in wide] == [("a", 20.0, True), ("b", 20.5, False), ("c", 1.0, True)]
    assert relational.measures_of_period(headers, items, WATER, datetime(2026, 5, 21), datetime(2026, 5, 22)).count() == 0


def test_weather_events_need_all_five(spark, tmp_path):
    rows = [(1, 1, AT, 20.0, 50.0, 0.0, 1.0, "sol"), (2, 1, AT, 20.0, None, 0.0, 1.0, "sol"), (3, 1, AT, 20.0, 50.0, 0.0, 1.0, " ")]
    df = spark.createDataFrame(rows, "id_estacao bigint, id_cidade bigint, data_leitura timestamp, temperatura_ar double, umidade double, chuva double, vento double, condicao string")
    events = relational.prepare(df, WEATHER)
    empty = (spark.createDataFrame([], relational.HEADERS), spark.createDataFrame([], relational.ITEMS))
    got = {r.chave_origem.split("|")[0]: (r.verdict, r.reasons) for r in relational.load_events(events, *empty, complete=5).verdicts.collect()}
    assert got == {"1": ("insert", []), "2": ("reject", ["items missing"]), "3": ("reject", ["blank text"])}
    assert events.where("exists(itens, i -> i.codigo_parametro = 'CONDICAO_METEO' and i.valor_texto = 'sol')").count() == 2
    approved, counts = relational.load_frame(df.withColumn("codigo_estacao", F.concat(F.lit("E"), "id_estacao")), WEATHER, str(tmp_path))
    assert counts == {"insert": 1, "reject": 2} and [(float(r.temperatura_ar), r.condicao, r.id_estacao) for r in approved.collect()] == [(20.0, "sol", 1)]
    assert relational.stored(spark, str(tmp_path))[0].first().chave_origem == "E1|2026-05-20T10:00:00.000000+00:00"


def test_events_that_repeat_in_a_batch(spark, tmp_path):
    folder = str(tmp_path)
    row = ("a", 1, None, AT, "20", "7", None, None, None)
    rows = [row, row, row, ("a", 1, 5, AT, "20.0", "7", None, None, None), ("a", 1, None, AT, "21", "7", None, None, None), ("a", 2, None, AT, "20", "7", None, None, None), ("b", 1, None, AT, "99", None, None, None, None), ("b", 1, None, AT, "9", None, None, None, None)]
    assert relational.persist_events(water(spark, *rows), folder) == {"insert": 2, "replay": 2, "enrich": 1, "reject": 3}
    headers, items = relational.stored(spark, folder)
    assert {(r.chave_origem, r.id_estacao, r.id_operador) for r in headers.collect()} == {("a", 1, 5), ("b", 1, None)}
    assert {(r.chave_origem, r.codigo_parametro, float(r.valor_numerico)) for r in items.collect()} == {("a", "TEMP_AGUA", 20.0), ("a", "PH", 7.0), ("b", "TEMP_AGUA", 9.0)}
    ordered = spark.createDataFrame([(2, *row), (1, "a2", 1, None, AT, "1", None, None, None, None), (3, "a2", 1, None, AT, "2", None, None, None, None)], "n int, " + WATER_SCHEMA)
    assert relational.persist_events(relational.prepare(ordered, WATER, ["n"]), folder) == {"replay": 1, "insert": 1, "reject": 1}
    assert float(relational.stored(spark, folder)[1].where("chave_origem = 'a2'").first().valor_numerico) == 1.0


@pytest.mark.parametrize("step", ["_written", "publish", "clean"])
def test_a_load_that_ends_midway_leaves_both_tables_or_neither(spark, tmp_path, monkeypatch, step):
    folder = str(tmp_path / "t")
    monkeypatch.setattr(relational, "CLEAN_EVERY", 1)
    relational.persist_events(water(spark, ("a", 1, None, AT, "20", "7", None, None, None)), folder)
    batch = water(spark, ("a", 1, 9, AT, "20", "7", None, None, None), ("b", 1, None, AT, "1", "2", None, None, None))
    real = getattr(relational, step)

    def killed(*args):
        if step == "_written":  # after the new folders are written, before they are published
            real(*args)
        raise OSError("killed")

    held = relational.stored(spark, folder)
    monkeypatch.setattr(relational, step, killed)
    with pytest.raises(OSError):
        relational.persist_events(batch, folder)
    monkeypatch.setattr(relational, step, real)
    headers, items = relational.stored(spark, folder)
    assert (headers.count(), items.count()) == ((2, 4) if step == "clean" else (1, 2))
    assert (held[0].count(), held[1].count()) == (1, 2)  # who began to read before goes on reading
    assert relational.persist_events(batch, folder) == ({"replay": 2} if step == "clean" else {"enrich": 1, "insert": 1})
    headers, items = relational.stored(spark, folder)
    assert {(r.chave_origem, r.id_operador) for r in headers.collect()} == {("a", 9), ("b", None)} and headers.count() == 2 and items.count() == 4


def test_many_loads_gather_their_folders(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "t")
    monkeypatch.setattr(relational, "MOST_FOLDERS", 3)
    monkeypatch.setattr(relational, "CLEAN_EVERY", 1)
    monkeypatch.setattr(relational, "clean", lambda *args: clean(*args, retention=0.0))
    for i in range(8):
        assert relational.persist_events(water(spark, (f"k{i}", 1, None, AT, "20", "7", None, None, None)), folder) == {"insert": 1}
    headers, items = relational.stored(spark, folder)
    assert headers.count() == 8 and items.count() == 16
    held = current(spark, folder).content
    assert len(held["headers"]) <= 4 and len(held["items"]) <= 4
    assert len([p for p in (tmp_path / "t" / "leitura_itens").iterdir()]) == len(held["items"])


def test_headers_that_lost_their_items_get_them_again(spark, tmp_path):
    folder, events = str(tmp_path), water(spark, ("a", 1, None, AT, "20", "7", None, None, None), ("b", 1, None, AT, "5", None, None, None, None))
    relational.persist_events(events, folder)
    items = relational.stored(spark, folder)[1].where("chave_origem = 'b'").collect()
    spark.createDataFrame(items, relational.ITEMS).write.mode("overwrite").parquet(f"{folder}/{current(spark, folder).content['items'][0]['folder']}")
    assert relational.persist_events(events, folder) == {"repair": 1, "replay": 1}
    assert relational.stored(spark, folder)[1].count() == 3 and relational.persist_events(events, folder) == {"replay": 2}


def test_references_are_checked_with_the_verdicts(spark, tmp_path):
    folder = str(tmp_path / "t")
    known = relational.References(spark.createDataFrame([(1,), (2,), (2,), (None,)], "id_estacao bigint"), spark.createDataFrame([(5,)], "id_operador bigint"), ["TEMP_AGUA", "PH"])
    rows = [("a", 1, 5, AT, "20", "7", None, None, None), ("b", 3, None, AT, "20", None, None, None, None), ("c", 2, 6, AT, "20", None, None, None, None), ("d", 2, None, AT, "20", None, "1", None, None), ("e", 3, 6, AT, None, None, "1", None, None)]
    done = relational.persist(water(spark, *rows), folder, references=known)
    assert done.counts == {"insert": 1, "reject": 4}
    why = relational.load_events(water(spark, *rows), *(spark.createDataFrame([], x) for x in (relational.HEADERS, relational.ITEMS)), references=known).verdicts
    assert {r.chave_origem: r.reasons for r in why.collect()} == {"a": [], "b": ["unknown station"], "c": ["unknown operator"], "d": ["unknown parameter"], "e": ["unknown station", "unknown operator", "unknown parameter"]}
    assert relational.stored(spark, folder)[0].count() == 1
    assert relational.persist_events(water(spark, *rows), folder) == {"replay": 1, "insert": 4}  # without registers nothing is held against them


def test_nothing_is_loaded_beside_an_old_table_with_rows(spark, tmp_path):
    old, events = str(tmp_path / "qualidade_agua"), water(spark, ("a", 1, None, AT, "20", None, None, None, None))
    spark.createDataFrame([("a",)], "id string").write.parquet(old)
    with pytest.raises(ValueError, match="migrate"):
        relational.persist(events, str(tmp_path / "t"), legacy=[old, str(tmp_path / "none")])
    spark.createDataFrame([], "id string").write.mode("overwrite").parquet(old)
    assert relational.persist(events, str(tmp_path / "t"), legacy=[old]).counts == {"insert": 1}


def test_archive_moves_that_fail_are_made_by_the_next_writer(spark, tmp_path, monkeypatch):
    stations, folder = spark.createDataFrame([(1,)], "id_estacao bigint"), str(tmp_path / "ok")
    spark.createDataFrame([("a", 1, None, AT, "20", "7", "1", "2", None)], WATER_SCHEMA).write.parquet(str(tmp_path / "old1"))
    spark.createDataFrame([(1,)], "x int").write.parquet(str(tmp_path / "old2"))
    moves, real = {str(tmp_path / f"old{i}"): str(tmp_path / f"kept{i}") for i in (1, 2)}, relational.move

    def second(spark, path, target):
        if path.endswith("old2"):
            raise OSError("no space")
        real(spark, path, target)

    monkeypatch.setattr(relational, "move", second)
    with pytest.raises(OSError):
        relational.migrate({WATER.name: spark.read.parquet(str(tmp_path / "old1"))}, folder, stations, moves)
    monkeypatch.undo()
    assert not (tmp_path / "old1").exists() and (tmp_path / "old2").exists() and relational.stored(spark, folder)[1].count() == 4
    assert relational.persist_events(water(spark, ("c", 1, None, AT, "1", None, None, None, None)), folder) == {"insert": 1}
    assert not (tmp_path / "old2").exists() and all((tmp_path / f"kept{i}" / "_READ_ONLY").exists() for i in (1, 2))
    assert "moves" not in current(spark, folder).content


def test_an_enrichment_rewrites_nothing(spark, tmp_path):
    folder = str(tmp_path)
    days = [AT.replace(day=d) for d in (1, 2, 3)]
    relational.persist_events(water(spark, *[(f"k{d.day}", 1, None, d, "20", None, None, None, None) for d in days]), folder)
    before = {(p.parent, p.name) for p in (tmp_path / "leituras").rglob("part-*.parquet")}
    assert relational.persist_events(water(spark, ("k2", 1, 7, days[1], "20", None, None, None, None)), folder) == {"enrich": 1}
    assert before == {(p.parent, p.name) for p in (tmp_path / "leituras").rglob("part-*.parquet") if p.stat().st_size and spark.read.parquet(str(p)).count()}
    headers, _ = relational.stored(spark, folder)
    assert {(r.chave_origem, r.id_operador) for r in headers.collect()} == {("k1", None), ("k2", 7), ("k3", None)}
    assert relational.persist_events(water(spark, ("k2", 1, 8, days[1], "20", None, None, None, None), ("k1", 1, None, days[0], "20", None, None, None, None)), folder) == {"reject": 1, "replay": 1}


def test_rules_of_headers(spark):
    rows = [("x" * 51, "k", None), ("E", "k", "0" * 63), ("E", "k", "0" * 64)]
    df = spark.createDataFrame([(c, k, 1, AT, "20", h, *[None] * 4) for c, k, h in rows], "codigo_estacao string, id_leitura_origem string, id_estacao bigint, data_leitura timestamp, temperatura_agua string, operador_cpf_hash string, ph string, oxigenio string, condutividade string, turbidez string")
    events = relational.prepare(df, WATER)
    assert [r.w for r in events.select(relational.header_reasons(events.columns).alias("w")).collect()] == [["station code too long"], ["no operator digest"], []]
    other = events.limit(1).withColumn("origem", F.lit(WEATHER.name)).withColumn("codigo_estacao", F.lit("E"))
    assert other.select(relational.header_reasons(other.columns).alias("w")).first().w == ["key of another reading"]


def test_registers(spark):
    none = spark.createDataFrame([("PH", "old", "pH"), ("X", "x", "x")], "codigo string, nome string, unidade_medida string")
    got = {r.codigo: r.verdict for r in relational.upsert_parameters(none).collect()}
    assert len(got) == 11 and got["PH"] == "update" and got["X"] == "replay" and got["OD"] == "insert"
    with pytest.raises(ValueError):
        relational.upsert_parameters(none, [("a", "n", "u"), ("A", "n", "u")])
    columns = "schema_name string, tabela string, campo_logico string, coluna_armazenada string, classificacao string, finalidade string, protecao string, politica_acesso string"
    assert relational.upsert_personal_catalogue(spark.createDataFrame([], columns)).where("verdict = 'insert'").count() == 2
    old = spark.createDataFrame([(1, "a")], "id int, n string")
    assert relational.append_new(spark.createDataFrame([(1, "b"), (2, "c")], "id int, n string"), old, ["id"]).orderBy("id").collect() == [(1, "a"), (2, "c")]


def test_operators_are_protected_and_updated(spark):
    key, token = b"a key for tests", "MDEyMzQ1Njc4OTAxMjM0NTY3ODkwMTIzNDU2Nzg5MDE="
    stations = spark.createDataFrame([("E1", 1), ("E2", 2)], "codigo_origem string, id_estacao bigint")
    rows = spark.createDataFrame([("529.982.247-25", " Ana ", "E1", "ativo"), ("111.111.111-11", "Bob", "E1", "ativo"), ("529.982.247-25", "Cid", "E9", None)], "cpf string, nome string, estacao_id string, status string")
    good, bad = relational.protect_operators(rows, stations, key, token)
    assert good.count() == 1 and bad.count() == 2 and "Ana" not in str(good.drop("_name").collect())
    columns = ["cpf_hash", "nome_completo_cifrado", "status", "id_estacao"]
    stored = spark.createDataFrame(good.select(*columns).collect(), "cpf_hash string, nome_completo_cifrado string, status int, id_estacao bigint")
    same, _ = relational.protect_operators(rows.limit(1).withColumn("status", F.lit(None).cast("string")), stations, key, token)
    assert [r.verdict for r in relational.upsert_operators(same, stored, token).collect()] == ["replay"]
    moved, _ = relational.protect_operators(rows.limit(1).withColumn("estacao_id", F.lit("E2")), stations, key, token)
    got = relational.upsert_operators(moved, stored, token).first()
    assert (got.verdict, got.id_estacao, got.nome_completo_cifrado) == ("update", 2, stored.first().nome_completo_cifrado)


def test_migration_moves_every_cell_or_nothing(spark, tmp_path):
    stations = spark.createDataFrame([(1,)], "id_estacao bigint")
    legacy = spark.createDataFrame([("a", 1, None, AT, "20", "7", "1", "2", None), ("b", 1, None, AT, "20", None, "1", "2", "0.5")], WATER_SCHEMA)
    old, kept = str(tmp_path / "qualidade_agua"), str(tmp_path / "legado_qualidade_agua")
    legacy.write.parquet(old)
    source = spark.read.parquet(old)
    for broken in (source.withColumn("id_estacao", F.lit(7).cast("bigint")), source.withColumn("ph", F.lit("99")), source.unionByName(source), source.drop("ph")):
        with pytest.raises(ValueError, match="preflight"):
            relational.migrate({WATER.name: broken}, str(tmp_path / "no"), stations, {old: kept})
    assert not exists(spark, str(tmp_path / "no" / "leituras")) and exists(spark, old)
    done = relational.migrate({WATER.name: source}, str(tmp_path / "ok"), stations, {old: kept})
    assert done.events == {"qualidade_agua": 2} and done.archived == [kept]
    assert relational.stored(spark, str(tmp_path / "ok"))[1].count() == 8
    assert not exists(spark, old) and exists(spark, f"{kept}/_READ_ONLY") and spark.read.parquet(kept).count() == 2
    # a table that holds something else for these events does not reconcile
    relational.persist_events(water(spark, ("a", 1, None, AT, "21", None, None, None, None)), str(tmp_path / "other"))
    with pytest.raises(ValueError):
        relational.migrate({WATER.name: spark.read.parquet(kept)}, str(tmp_path / "other"), stations)
    assert relational.stored(spark, str(tmp_path / "other"))[1].count() == 1


def test_operators_come_from_a_document(spark, tmp_path):
    path, key, token = tmp_path / "operators.json", b"a key for tests", "MDEyMzQ1Njc4OTAxMjM0NTY3ODkwMTIzNDU2Nzg5MDE="
    stations = spark.createDataFrame([("E1", 1)], "codigo_origem string, id_estacao bigint")
    none = spark.createDataFrame([], "cpf_hash string, nome_completo_cifrado string, status int, id_estacao bigint")
    path.write_text(json.dumps({"date": "2026-01-01", "operadores": [{"cpf": "529.982.247-25", "nome": "Ana", "status": "ativo", "estacao_id": "E1"}, {"cpf": "111.111.111-11", "nome": "Bob", "estacao_id": "E1"}, {"nome": "no station"}]}, indent=2))
    rows, date = relational.read_operators(spark, str(path))
    assert date == "2026-01-01" and rows.count() == 2
    good, bad = relational.load_operators(rows, none, stations, key, token, dated=True)
    assert (good.count(), bad.count()) == (1, 1)
    with pytest.raises(ValueError):
        relational.load_operators(rows, none, stations, key, token, dated=False)
    for broken in ("{no json", "[]", '{"operadores": 3}'):
        path.write_text(broken)
        rows, date = relational.read_operators(spark, str(path))
        assert date is None and rows.count() == 0


def test_a_register_is_replaced_as_a_whole(spark):
    old, used = spark.createDataFrame([(1, "a"), (2, "b")], "id int, n string"), spark.createDataFrame([(2,)], "ref int")
    assert relational.replace_register(old.where("id = 2"), old, ["id"], used, "ref").count() == 1
    for bad in (old.where("id = 1"), old.union(old)):
        with pytest.raises(ValueError):
            relational.replace_register(bad, old, ["id"], used, "ref")


class _Api(http.server.BaseHTTPRequestHandler):
    def do_GET(self):
        path = self.path.split("?")[0]
        day = {"data": "2026-01-01", "temperatura_minima": 10.5, "temperatura_minima_estimada": False, "temperatura_media": None, "temperatura_maxima": 30.0, "temperatura_maxima_estimada": True, "precipitacao": 0.0}
        body = {"/estacoes": [{"id": 7}, {"idEstacao": 8}, 9], "/clima/7": [day], "/clima/8": {}}.get(path)
        self.send_response(200 if body is not None and self.headers.get("Authorization") == "Bearer t" else 404)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *_):
        pass


def test_collector(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), _Api)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    try:
        got = collector.collect(spark, base, [("SP", "1")], "2026-01-01", "2026-01-02", "t", per_minute=1000, tasks=4)
        assert {(r.id_estacao, r.climate is None) for r in got.collect()} == {(7, False), (8, False), (9, True)}
        assert got.count() == 3  # no request is made again
        assert collector.collect(spark, base, spark.createDataFrame([("SP", "1")], "uf string, id_municipio string"), "2026-01-01", "2026-01-02", "other", per_minute=1000).count() == 0
    finally:
        server.shutdown()
    assert inspect.getsource(collector.collect).count(".collect()") == 0
    with pytest.raises(ValueError):
        collector.fetch(spark.createDataFrame([(base,)], "url string"), " ")
    with pytest.raises(ValueError):
        collector.fetch(spark.createDataFrame([("ftp://x",)], "url string"), "t")


def test_tasks_share_the_calls_a_minute(spark, monkeypatch):
    calls, lock = [], threading.Lock()

    class Slow(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            with lock:
                calls.append(time.monotonic())
            self.send_response(200)
            self.end_headers()
            self.wfile.write(b"1")

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Slow)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    # a minute of two seconds, so that the test need not wait for a real one
    monkeypatch.setattr(raw.RateLimit, "WINDOW", 2.0)
    try:
        requests = spark.range(30).selectExpr(f"concat('http://127.0.0.1:{server.server_port}/', id) as url")
        assert raw.get_all(requests, "t", tasks=4, per_minute=8).where("status = 200").count() == 30
    finally:
        server.shutdown()
    assert len(calls) == 30
    assert all(sum(a <= t < a + 1.9 for t in calls) <= 8 for a in calls)


def test_contract_of_collected_results(spark):
    good = {"uf": "SP", "id_municipio": "1", "id_estacao": 7, "capturado_em": "2026-01-01T00:00:00Z", "detalhes_estacao": {"id": 7}, "dados_climaticos": [{"data": "2026-01-01", "temperatura_minima": 1}]}
    rows = [good, good | {"dados_climaticos": {}}, good | {"uf": "S1"}, {k: v for k, v in good.items() if k != "id_estacao"}, good | {"dados_climaticos": [{"data": "2026-02-30"}]}, good | {"dados_climaticos": [{"data": "2026-01-01", "precipitacao": "1"}]}]
    df = spark.createDataFrame([(json.dumps(r),) for r in rows], "r string").selectExpr("parse_json(r) as result")
    reasons = [r.x for r in df.select(collector.result_reasons().alias("x")).collect()]
    assert reasons[:4] == [[], [], ["uf: not two letters"], ["id_estacao: missing"]] and reasons[4] == reasons[5] == ["dados_climaticos: a day breaks its contract"]
    assert collector.temperatures(df).count() == 1
