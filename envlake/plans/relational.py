"""The relational model: headers and items of events, registers, and migration of wide tables.

An event travels as one row, its header with its items in an array. Verdicts are
found by joins over whole batches. An event is accepted or rejected as a whole. Both
tables are one folder with one log (sources/versions.py): headers and items of a load
are written under new names and published by one snapshot, so a reader sees neither or
both, and a load that ends midway leaves the tables as they were. What a migration
still has to move into the archive is in the same snapshot, and the next writer
finishes it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..domain import ACTIVE, CONTRACTS, INACTIVE, LIMITS, PARAMETERS, PERSONAL_DATA, WATER, Contract
from ..domain import contract as dataset
from ..functions.numbers import exact_decimal
from ..functions.personal import cpf_pseudonym, encrypt_name, read_names
from ..functions.text import active_flag, trimmed
from ..functions.times import half_open, natural_key
from ..operators import joins, upsert
from ..operators.constraints import NotNull, Unique, enforce
from ..operators.keys import duplicate_keys
from ..operators.quality import any_of
from ..operators.reshape import event_rows
from ..scratch import written
from ..sources.files import exists, move, remove, write_text
from ..sources.versions import Lease, Snapshot, clean, current, leased, new_folder, publish, to_gather

# The columns of both tables.
HEADERS = "origem string, chave_origem string, id_estacao bigint, id_operador bigint, data_leitura timestamp"
ITEMS = "origem string, chave_origem string, codigo_parametro string, valor_numerico decimal(18,6), valor_texto string"
EVENT = ["origem", "chave_origem"]
HEADER = [*EVENT, "id_estacao", "id_operador", "data_leitura"]
OPERATORS = "origem string, chave_origem string, id_operador bigint"
#: Folders of a table beyond which a load puts them together; old files are looked for every so many versions.
MOST_FOLDERS, CLEAN_EVERY = 8, 8
#: Longest texts of a header.
KEY_LENGTH, STATION_LENGTH = 150, 50


def header_reasons(columns: Sequence[str] = ()) -> list:
    """Rules of a header, by reason; of the columns codigo_estacao and operador_cpf_hash where there are any."""
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    rules = {
        "unknown origin": ~F.coalesce(F.col("origem").isin(*CONTRACTS), F.lit(False)),
        "no key": blank("chave_origem"),
        "key too long": F.length("chave_origem") > KEY_LENGTH,
        "no station": F.col("id_estacao").isNull(),
        "no instant": F.col("data_leitura").isNull(),
        "key of another reading": (F.col("origem") != WATER.name) & (F.col("chave_origem") != natural_key(F.col("codigo_estacao") if "codigo_estacao" in columns else F.col("id_estacao"), F.col("data_leitura"))),
    }
    if "codigo_estacao" in columns:
        rules["station code too long"] = F.length(F.trim("codigo_estacao")) > STATION_LENGTH
    if "operador_cpf_hash" in columns:
        rules["no operator digest"] = ~operator_hash_valid(F.col("operador_cpf_hash"))
    return upsert.names_of(rules)


def operator_hash_valid(c):
    """Whether a column is null or a digest of 64 hex digits."""
    return c.isNull() | c.rlike("^[0-9a-f]{64}$")


def prepare(readings: DataFrame, contract: Contract, order: Sequence[str] = ()) -> DataFrame:
    """Wide readings as events: header columns, ordem (the given columns, by which of several rows with a key the first is told), and itens.

    A null measure is no item, a water event may lack some, a weather event none.
    """
    key = trimmed(F.col("id_leitura_origem")) if contract is WATER else natural_key(F.col("codigo_estacao") if "codigo_estacao" in readings.columns else F.col("id_estacao"), F.col("data_leitura"))
    item = lambda code, number, text: F.struct(F.lit(code).alias("codigo_parametro"), number.cast("string").alias("numero"), text.cast("string").alias("valor_texto"))
    parts = [item(code, F.col(c), F.lit(None)) for c, code in contract.codes.items()]
    if "condicao" in readings.columns:
        parts.append(item("CONDICAO_METEO", F.lit(None), F.col("condicao")))
    items = F.filter(F.array(*parts), lambda x: x["numero"].isNotNull() | x["valor_texto"].isNotNull())
    operator = F.col("id_operador").cast("bigint") if "id_operador" in readings.columns else F.lit(None).cast("bigint")
    turn = F.struct(*[F.col(c) for c in order]) if order else F.struct(F.lit(0).alias("n"))
    more = [c for c in ("codigo_estacao", "operador_cpf_hash") if c in readings.columns]
    return readings.select(F.lit(contract.name).alias("origem"), key.alias("chave_origem"), F.col("id_estacao").cast("bigint").alias("id_estacao"), operator.alias("id_operador"), "data_leitura", *more, turn.alias("ordem"), items.alias("itens"))


@dataclass
class EventLoad:
    """What a batch of events does: new headers and items, enriched headers, what was accepted, and verdicts.

    verdicts has (event, verdict, reasons, n): n rows of the batch had it. accepted has
    the events, in their stored form, that were not rejected.
    """

    headers: DataFrame
    items: DataFrame
    enriched: DataFrame
    accepted: DataFrame
    verdicts: DataFrame


@dataclass(frozen=True)
class References:
    """What headers and items may refer to: registers with id_estacao and with id_operador, and codes of parameters; None is not checked."""

    stations: DataFrame | None = None
    operators: DataFrame | None = None
    codes: Sequence[str] | None = None


def load_events(events: DataFrame, stored_headers: DataFrame, stored_items: DataFrame, complete: int = 1, references: References = References()) -> EventLoad:  # noqa: B008
    """Classify whole events: judge() and outcome() in one."""
    return outcome(judge(events, stored_headers, stored_items, complete, references))


def _orphaned(rows: DataFrame, references: References) -> DataFrame:
    """rows with `orphan`, why their references are to nothing; a null one refers to nothing and is right.

    A register has a row for each station or operator, so Spark sends a small one to the
    rows, and splits a hot station of a large one, as nothing is aggregated above.
    """
    why = []
    for column, register, reason in (("id_estacao", references.stations, "unknown station"), ("id_operador", references.operators, "unknown operator")):
        if register is not None:
            known = register.select(F.col(column).cast("bigint").alias(f"_known_{column}")).where(f"_known_{column} is not null").distinct()
            rows = rows.join(known, F.col(column) == F.col(f"_known_{column}"), "left")
            why.append(F.when(F.col(column).isNotNull() & F.col(f"_known_{column}").isNull(), F.lit(reason)))
    if references.codes is not None:
        known = [F.lit(c) for c in references.codes]
        strange = F.exists("itens", lambda x: ~F.coalesce(F.array_contains(F.array(*known), x["codigo_parametro"]), F.lit(False)))
        why.append(F.when(strange, F.lit("unknown parameter")))
    found = F.filter(F.array(*why), lambda x: x.isNotNull()) if why else F.array().cast("array<string>")
    return rows.withColumn("orphan", found).drop("_known_id_estacao", "_known_id_operador")


def judge(events: DataFrame, stored_headers: DataFrame, stored_items: DataFrame, complete: int = 1, references: References = References(), keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:  # noqa: B008
    """The different rows of events with what stands against each and what its first copy does.

    An event is rejected if its header or an item breaks a rule, its station, operator or
    a code is not in the references, it has fewer items than complete, its header conflicts with the stored one, or its codes and values
    are not those stored. The first of a key that is not rejected, by ordem and then by
    its content, stands for it: later ones with the same content are replays, others are
    rejected. An operator is added where there was none. A stored header that has no
    items, as after a load that was lost midway, gets those of its event (repair).
    Identical rows are counted before they are shuffled. keep writes the rows with what
    they are held against, from which their firsts are told and to which these are
    joined, and reads them again; without it they are kept until the session ends.
    """
    read = F.transform("itens", lambda x: F.struct(x["codigo_parametro"].alias("codigo_parametro"), exact_decimal(x["numero"]).alias("valor_numerico"), x["valor_texto"].alias("valor_texto"), x["numero"].alias("numero")))
    rules = lambda x: upsert.item_rules(x["codigo_parametro"], x["numero"], x["valor_texto"], LIMITS, x["valor_numerico"])
    broken = F.when(F.exists("_read", lambda x: any_of(list(rules(x).values()))), F.array_distinct(F.flatten(F.transform("_read", lambda x: upsert.names_of(rules(x)))))).otherwise(upsert.no_names())
    exact = F.sort_array(F.transform("_read", lambda x: F.struct(x["codigo_parametro"].alias("codigo_parametro"), x["valor_numerico"].alias("valor_numerico"), x["valor_texto"].alias("valor_texto"))))
    codes = F.transform("itens", lambda x: x["codigo_parametro"])
    given = lambda *pairs: upsert.names_of(dict(pairs))
    own = given(("items missing", F.size("itens") < complete), ("a code repeats", F.size(F.array_distinct(codes)) < F.size(codes)))
    # a key before its origin, which few rows differ in: sorts then compare the first bytes alone
    event = EVENT[::-1]
    content = ["id_estacao", "data_leitura", "valores"]
    rows = _orphaned(events, references).withColumn("_read", read).withColumn("why", F.concat(header_reasons(events.columns), F.col("orphan"), broken, own)).withColumn("valores", exact)
    rows = rows.groupBy(*event, *content, "id_operador", "why").agg(F.count("*").alias("n"), F.min("ordem").alias("ordem"))

    held = stored_items.groupBy(*event).agg(F.sort_array(F.collect_list(F.struct("codigo_parametro", "valor_numerico", "valor_texto"))).alias("_items"))
    old = stored_headers.select(*EVENT, F.struct("id_estacao", "data_leitura", "id_operador").alias("_old")).join(held, event, "left")
    rows = rows.join(old, event, "left")
    differs = lambda base: (F.col("id_estacao") != F.col(f"{base}.id_estacao")) | (F.col("data_leitura") != F.col(f"{base}.data_leitura"))
    other = lambda c: F.coalesce(F.col("id_operador") != F.col(c), F.lit(False))
    known = F.col("_old").isNotNull()
    against = given(("header conflict", known & (differs("_old") | other("_old.id_operador"))), ("item conflict", F.col("_items") != F.col("valores")))
    rows = rows.withColumn("why", F.concat("why", against))
    rows = keep(rows) if keep else written(rows, "events")

    able = rows.where(F.size("why") == 0)
    operator = F.min(F.when(F.col("id_operador").isNotNull(), F.struct("ordem", "id_operador")))
    versions = able.groupBy(*event, *content).agg(F.min(F.struct("ordem", "id_operador")).alias("lead"), operator.alias("operator"))
    first = versions.groupBy(*event).agg(F.min(F.struct("lead", *content, "operator")).alias("first"))
    rows = rows.join(first, event, "left")
    clash = given(("header conflict", differs("first") | other("first.operator.id_operador")), ("item conflict", F.col("valores") != F.col("first.valores")))
    rows = rows.withColumn("why", F.when(F.size("why") > 0, F.col("why")).otherwise(clash))

    lead = F.struct("ordem", "id_operador").eqNullSafe(F.col("first.lead"))
    adds = F.col("id_operador").isNotNull() & F.col("_old.id_operador").isNull() & F.struct("ordem", "id_operador").eqNullSafe(F.col("first.operator"))
    one = F.when(lead & ~known, upsert.INSERT).when(lead & F.col("_items").isNull(), upsert.REPAIR).when(adds, upsert.ENRICH)
    rows = rows.withColumns({"one": F.when(F.size("why") == 0, one), "lead": (F.size("why") == 0) & lead, "known": known})
    return rows.select(*EVENT, *content, "id_operador", "n", "why", "one", "lead", "known", F.col("_items").isNull().alias("bare"), F.col("_old.id_operador").alias("old_operator"), F.col("first.operator.id_operador").alias("new_operator"))


def outcome(rows: DataFrame) -> EventLoad:
    """What judged events do to the tables."""
    parts = F.when(F.size("why") > 0, F.array(F.struct(F.lit(upsert.REJECT).alias("verdict"), F.col("n").alias("n")))).otherwise(
        F.filter(
            F.array(F.struct(F.col("one").alias("verdict"), F.lit(1).cast("bigint").alias("n")), F.struct(F.lit(upsert.REPLAY).alias("verdict"), F.when(F.col("one").isNull(), F.col("n")).otherwise(F.col("n") - 1).alias("n"))),
            lambda v: v["verdict"].isNotNull() & (v["n"] > 0),
        )
    )
    verdicts = rows.select(*EVENT, F.col("why").alias("reasons"), F.explode(parts).alias("v")).select(*EVENT, "v.verdict", "reasons", "v.n")
    won = rows.where("lead")
    header = won.select(*EVENT, "id_estacao", F.coalesce("old_operator", "new_operator").alias("id_operador"), "data_leitura", (~F.col("known")).alias("_new"), (F.col("known") & F.col("old_operator").isNull() & F.col("new_operator").isNotNull()).alias("_more"))
    items = won.where("bare").select(*EVENT, F.explode("valores").alias("v")).select(*EVENT, "v.*")
    return EventLoad(header.where("_new").select(*HEADER), items, header.where("_more").select(*HEADER), won.select(*EVENT, "id_estacao", "data_leitura", "valores"), verdicts)


def wide_events(accepted: DataFrame, contract: Contract) -> DataFrame:
    """Accepted events as the wide readings that were stored, a row for each event."""
    value = lambda code, name: F.element_at(F.filter("valores", lambda x: x["codigo_parametro"] == code), 1)[name]
    values = F.transform("valores", lambda x: x["codigo_parametro"])
    at = {c: F.when(F.array_contains(values, code), value(code, "valor_numerico")).alias(c) for c, code in contract.codes.items()}
    more = [F.col("chave_origem").alias("id_leitura_origem")] if contract is WATER else [F.when(F.array_contains(values, "CONDICAO_METEO"), value("CONDICAO_METEO", "valor_texto")).alias("condicao")]
    return accepted.where(F.col("origem") == contract.name).select(*at.values(), "data_leitura", "id_estacao", *more)


def stored(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(headers, items) of the tables in a folder as its latest snapshot has them, empty if there are none."""
    return _tables(spark, folder, current(spark, folder).content)


def _read(spark: SparkSession, folder: str, schema: str, folders: list[dict[str, Any]]) -> DataFrame:
    paths = [f"{folder}/{f['folder']}" for f in folders]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _tables(spark: SparkSession, folder: str, content: dict[str, Any]) -> tuple[DataFrame, DataFrame]:
    """Headers with the operators that were added later, and items, of a snapshot."""
    headers = _read(spark, folder, HEADERS, content.get("headers", []))
    if content.get("operators"):
        added = _read(spark, folder, OPERATORS, content["operators"]).withColumnRenamed("id_operador", "_added")
        headers = headers.join(added, EVENT, "left").withColumn("id_operador", F.coalesce("id_operador", "_added")).select(*HEADER)
    return headers, _read(spark, folder, ITEMS, content.get("items", []))


def _used(content: dict[str, Any]) -> list[str]:
    """The folders that a snapshot needs."""
    return [*[f["folder"] for kind in ("headers", "operators", "items") for f in content.get(kind, [])], *content.get("judged", [])]


def _added(spark: SparkSession, folder: str, place: str, rows: DataFrame, held: list[dict[str, Any]], order: Sequence[str]) -> list[dict[str, Any]]:
    """The folders of a table with new rows in one more, which also takes in others when there are many; files are ranges of the order, so that readers skip those they need not."""
    if not held and rows.isEmpty():
        return held
    gathered = to_gather(held, MOST_FOLDERS)
    fresh = f"{place}/{new_folder()}"
    rows = rows.unionByName(_read(spark, folder, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields), gathered))
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{folder}/{fresh}")
    n = spark.read.schema(rows.schema).parquet(f"{folder}/{fresh}").count()
    return [*[f for f in held if f not in gathered], *([{"folder": fresh, "rows": n}] if n else [])]


def _written(spark: SparkSession, folder: str, content: dict[str, Any], load: EventLoad) -> dict[str, Any]:
    """Write what a load adds under new names; what the folder will hold.

    Nothing that is there is written anew: an operator that a stored header gets is a row
    of its own, joined when headers are read; an event gets one once at most.
    """
    enforce(load.items, [NotNull((*EVENT, "codigo_parametro")), Unique((*EVENT, "codigo_parametro"))], "the new items")
    enforce(load.headers, [NotNull((*EVENT, "id_estacao", "data_leitura")), Unique(tuple(EVENT))], "the new headers")
    add = lambda kind, place, rows, order: _added(spark, folder, place, rows, content.get(kind, []), order)
    return content | {
        "headers": add("headers", "leituras", load.headers, ("data_leitura", *EVENT)),
        "operators": add("operators", "leitura_operadores", load.enriched.select(*EVENT, "id_operador"), EVENT),
        "items": add("items", "leitura_itens", load.items, (*EVENT, "codigo_parametro")),
    }


def _publish(spark: SparkSession, folder: str, seen: Snapshot, content: dict[str, Any], lease: Lease) -> Snapshot:
    done = publish(spark, folder, seen, content, lease)
    if done.version % CLEAN_EVERY == 0:
        clean(spark, folder, ("leituras", "leitura_operadores", "leitura_itens", "_judged"), _used, lease)
    return done


def recover(spark: SparkSession, folder: str, lease: Lease) -> Snapshot:
    """The latest snapshot, after the moves that it promises and a writer that is gone did not make."""
    seen = current(spark, folder)
    moves = seen.content.get("moves", [])
    for path, target in moves:
        if exists(spark, path):
            move(spark, path, target)
        write_text(spark, f"{target}/_READ_ONLY", "")
    return _publish(spark, folder, seen, {k: v for k, v in seen.content.items() if k != "moves"}, lease) if moves else seen


def require_migrated(spark: SparkSession, legacy: Sequence[str]) -> None:
    """An error if an old wide table is still in its place with rows: it must be migrated and put into the archive before anything is loaded beside it."""
    for path in legacy:
        if exists(spark, path) and not exists(spark, f"{path.rstrip('/')}/_READ_ONLY") and not spark.read.parquet(path).isEmpty():
            raise ValueError(f"{path} still holds rows: migrate and archive it before loading")


def _judged(events: DataFrame, folder: str, seen: Snapshot, complete: int, references: References) -> str:
    """Judge events against the tables of a snapshot; the folder of the verdicts, which holds nothing else when it is done."""
    spark, judged, known = events.sparkSession, f"_judged/{new_folder()}", f"{folder}/_judged/{new_folder()}"

    def keep(rows: DataFrame) -> DataFrame:
        rows.write.parquet(known)
        return spark.read.schema(rows.schema).parquet(known)

    try:
        judge(events, *_tables(spark, folder, seen.content), complete, references, keep).write.parquet(f"{folder}/{judged}")
    finally:
        remove(spark, known)
    return judged


@dataclass
class Persisted:
    """How many rows of the batch had each verdict, the accepted events, and every event's verdicts with reasons."""

    counts: dict[str, int]
    accepted: DataFrame
    verdicts: DataFrame


def persist(events: DataFrame, folder: str, complete: int = 1, references: References = References(), legacy: Sequence[str] = ()) -> Persisted:  # noqa: B008
    """Load events into the tables of a folder, all of the batch or nothing of it.

    legacy: folders of old wide tables, which must not hold rows any more.
    """
    spark, folder = events.sparkSession, folder.rstrip("/")
    require_migrated(spark, legacy)
    with leased(spark, folder) as lease:
        seen = recover(spark, folder, lease)
        judged = _judged(events, folder, seen, complete, references)
        load = outcome(spark.read.parquet(f"{folder}/{judged}"))
        counts = {r.verdict: r.n for r in load.verdicts.groupBy("verdict").agg(F.sum("n").alias("n")).collect()}
        if counts.keys() & {upsert.INSERT, upsert.REPAIR, upsert.ENRICH}:
            _publish(spark, folder, seen, _written(spark, folder, seen.content, load) | {"judged": [judged]}, lease)
    return Persisted(counts, load.accepted, load.verdicts)


def persist_events(events: DataFrame, folder: str, complete: int = 1, references: References = References()) -> dict[str, int]:  # noqa: B008
    """Load events into the tables of a folder; how many rows had each verdict."""
    return persist(events, folder, complete, references).counts


def load_frame(readings: DataFrame, contract: Contract, folder: str, order: Sequence[str] = (), references: References = References(), legacy: Sequence[str] = ()) -> tuple[DataFrame, dict[str, int]]:  # noqa: B008
    """(approved readings, counts of verdicts): wide readings into the tables; those that were accepted come back as they are stored."""
    done = persist(prepare(readings, contract, order), folder, 1 if contract is WATER else len(contract.codes) + 1, references, legacy)
    return wide_events(done.accepted, contract), done.counts


def measures_of_period(headers: DataFrame, items: DataFrame, contract: Contract, start, end) -> DataFrame:
    """Wide readings of an origin in [start, end); incomplete events stay, with nulls."""
    own = headers.where((F.col("origem") == contract.name) & half_open(F.col("data_leitura"), start, end))
    texts = [] if contract is WATER else ["CONDICAO_METEO"]
    value = F.coalesce(F.col("valor_numerico").cast("string"), F.col("valor_texto"))
    rows = event_rows(own, items.select(*EVENT, "codigo_parametro", value.alias("v")), EVENT, [*contract.codes.values(), *texts], "codigo_parametro", "v")
    return rows.select(*EVENT, "id_estacao", "data_leitura", *[F.col(code).cast("decimal(18,6)").alias(c) for c, code in contract.codes.items()], *[F.col(t).alias("condicao") for t in texts])


def upsert_parameters(existing: DataFrame, rows: list[tuple[str, str, str]] = PARAMETERS) -> DataFrame:
    """The register of parameters with the given ones added or updated; codes are upper case and must not repeat."""
    if len({r[0].strip().upper() for r in rows}) != len(rows) or any(not x or not x.strip() for r in rows for x in r) or any(len(r[0]) > 50 or len(r[1]) > 150 or len(r[2]) > 50 for r in rows):
        raise ValueError("parameters need distinct codes, and names and units that are not blank or too long")
    new = existing.sparkSession.createDataFrame([(c.strip().upper(), n, u) for c, n, u in rows], "codigo string, nome string, unidade_medida string")
    return upsert.upsert(new, existing, ["codigo"], ["nome", "unidade_medida"])


def upsert_personal_catalogue(existing: DataFrame) -> DataFrame:
    """The catalogue of personal data, with the library's entries added or updated."""
    columns = ["schema_name", "tabela", "campo_logico", "coluna_armazenada", "classificacao", "finalidade", "protecao", "politica_acesso"]
    new = existing.sparkSession.createDataFrame(PERSONAL_DATA, ", ".join(f"{c} string" for c in columns))
    return upsert.upsert(new, existing, columns[:3], columns[3:])


def protect_operators(rows: DataFrame, stations: DataFrame, hmac_key: bytes, token_key: str) -> tuple[DataFrame, DataFrame]:
    """(protected, rejected) operators: the CPF as a keyed digest, the name encrypted, the station resolved."""
    seen = rows.select(cpf_pseudonym(F.col("cpf"), hmac_key).alias("cpf_hash"), trimmed(F.col("nome")).alias("_name"), active_flag(F.col("status"), ACTIVE, INACTIVE).alias("status"), trimmed(F.col("estacao_id")).alias("codigo_origem"))
    found = seen.join(stations.select("codigo_origem", "id_estacao"), "codigo_origem", "left")
    bad = F.col("cpf_hash").isNull() | F.col("_name").isNull() | F.col("id_estacao").isNull()
    good = found.where(~bad)
    return good.select("cpf_hash", encrypt_name(F.col("_name"), token_key).alias("nome_completo_cifrado"), "_name", "status", "id_estacao"), found.where(bad).select("cpf_hash", "codigo_origem", "id_estacao")


def upsert_operators(protected: DataFrame, existing: DataFrame, token_key: str) -> DataFrame:
    """Operators by their digest: a name is encrypted anew only if it changed, and a null status keeps the old one."""
    old = existing.withColumn("_old_name", read_names(F.col("nome_completo_cifrado"), token_key, principal="loader", authorize=lambda who, what: (who, what) == ("loader", "read_name")))
    kept = protected.join(old.select("cpf_hash", "_old_name", F.col("nome_completo_cifrado").alias("_old_token")), "cpf_hash", "left")
    token = F.when(F.col("_name") == F.col("_old_name"), F.col("_old_token")).otherwise(F.col("nome_completo_cifrado"))
    new = kept.select("cpf_hash", token.alias("nome_completo_cifrado"), "status", "id_estacao")
    return upsert.upsert(new, existing, ["cpf_hash"], ["nome_completo_cifrado", "status", "id_estacao"], keep_if_null=["status"])


def append_new(rows: DataFrame, existing: DataFrame, key: list[str]) -> DataFrame:
    """A register with the rows whose key it lacks; rows that it has stay as they are."""
    return existing.unionByName(joins.new_rows(rows, existing, key), allowMissingColumns=True)


def replace_register(rows: DataFrame, existing: DataFrame, key: list[str], used: DataFrame | None = None, reference: str | None = None) -> DataFrame:
    """A register replaced as a whole: keys must be unique, and none that another table refers to may go."""
    enforce(rows, [NotNull(tuple(key)), Unique(tuple(key))], "the register")
    if used is not None and reference is not None:
        gone = joins.new_rows(existing.select(*key), rows, key)
        joins.delete_with_children(existing, used, gone, key[0], reference, cascade=False)
    return rows


def read_operators(spark: SparkSession, path: str) -> tuple[DataFrame, str | None]:
    """(operators, their date or None) of a JSON document {date, operadores: [...]}; one that can't be read has no rows.

    Rows are (cpf, nome, status, estacao_id) as texts; those without a station are left out.
    """
    text = "struct<cpf:string,nome:string,status:string,estacao_id:string>"
    documents = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    date = documents.select(F.try_variant_get("v", "$.date", "string").alias("d")).first()
    rows = documents.select(F.explode(F.try_variant_get("v", "$.operadores", f"array<{text}>")).alias("o")).select("o.*")
    return rows.where(trimmed(F.col("estacao_id")).isNotNull()), date.d if date else None


def load_operators(rows: DataFrame, existing: DataFrame, stations: DataFrame, hmac_key: bytes, token_key: str, dated: bool) -> tuple[DataFrame, DataFrame]:
    """(operators with verdicts, rejected rows): undated rows are loaded all or none, dated ones each by itself."""
    good, bad = protect_operators(rows, stations, hmac_key, token_key)
    if not dated:
        n = bad.count()
        if n:
            raise ValueError(f"{n} operators are not acceptable; none is loaded")
    return upsert_operators(good.dropDuplicates(["cpf_hash"]), existing, token_key), bad


@dataclass
class Reconciled:
    """What a migration moved: events of each origin, and the tables that it put into the archive."""

    events: dict[str, int]
    archived: list[str]


def migrate(legacy: dict[str, DataFrame], folder: str, stations: DataFrame, archive: dict[str, str] | None = None) -> Reconciled:
    """Load wide tables, by dataset, as events: one unit, checked before anything is published.

    Preflight: required columns, registered stations, keys that don't repeat, rules of
    every event, archives that are not there yet. Then what the tables will hold is
    compared with the old ones cell by cell, headers and items; only if nothing is
    missing or besides is it published. archive maps an old table's folder to where it
    is moved; a moved table has a file that marks it as read only. The moves are
    published with the tables, so that one that fails is made by the next writer.
    """
    spark, folder = stations.sparkSession, folder.rstrip("/")
    moves = [[path.rstrip("/"), target.rstrip("/")] for path, target in (archive or {}).items()]
    for path, target in moves:
        if not exists(spark, path) or exists(spark, target):
            raise ValueError(f"preflight: {path} can't be moved to {target}")
    parts = []
    for name, table in legacy.items():
        contract = dataset(name)
        missing = [c for c in ("id_estacao", contract.instant, *contract.codes, *(["id_leitura_origem"] if contract is WATER else ["condicao"])) if c not in table.columns]
        if missing:
            raise ValueError(f"preflight: {contract.name} lacks {', '.join(missing)}")
        if not joins.orphans(table, stations, {"id_estacao": "id_estacao"}).isEmpty():
            raise ValueError("preflight: rows of the old table have no registered station")
        parts.append(prepare(table, contract))
    events = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if not duplicate_keys(events, EVENT).isEmpty():
        raise ValueError("preflight: a natural key repeats")
    with leased(spark, folder) as lease:
        seen = recover(spark, folder, lease)
        judged = _judged(events, folder, seen, 1, References(stations, codes=[p[0] for p in PARAMETERS]))
        load = outcome(spark.read.parquet(f"{folder}/{judged}"))
        if not load.verdicts.where(F.col("verdict") == upsert.REJECT).isEmpty():
            raise ValueError("preflight: rows of the old table break the rules of the new ones")
        content = _written(spark, folder, seen.content, load)
        headers, items = _tables(spark, folder, content)
        exact = events.select(*EVENT, "id_estacao", "data_leitura", F.explode("itens").alias("i"))
        want = exact.select(*EVENT, "id_estacao", "data_leitura", "i.codigo_parametro", exact_decimal(F.col("i.numero")).alias("valor_numerico"), "i.valor_texto")
        have = items.join(events.select(*EVENT), EVENT, "left_semi").join(headers.select(*EVENT, "id_estacao", "data_leitura"), EVENT)
        lost, extra = upsert.differences(want, have)
        if not (lost.isEmpty() and extra.isEmpty() and joins.orphans(items, headers, {c: c for c in EVENT}).isEmpty()):
            raise ValueError("reconciliation: the tables would not hold what the old ones do")
        moved = {r.origem: r.n for r in events.groupBy("origem").agg(F.count("*").alias("n")).collect()}
        _publish(spark, folder, seen, content | {"judged": [judged], "moves": moves}, lease)
        recover(spark, folder, lease)
    return Reconciled(moved, [target for _, target in moves])
