"""The whole flow: raw batches to clean tables by day to reports, and to the relational model.

Rows that break a rule are told from the others before the first row of a key is
chosen; they are kept with their reasons beside the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..domain import CITY_ALIASES, CONTRACTS, PARAMETERS, Contract, contract
from ..functions.text import trimmed
from ..functions.times import exclusive_days, half_open
from ..operators.joins import lookup, match_places
from ..operators.keys import dimension_keys, keep_first
from ..operators.quality import reason_counts, require_columns, row_rules, split
from ..scratch import written
from ..sources.raw import flatten, read_lines
from ..sources.tables import Written, merge, rebuild
from ..sources.versions import clean, current, leased, new_folder, publish
from .relational import References, load_frame, measures_of_period, stored
from .reports import publish_star, read_measures

#: The snapshots of the registers, and the reason of a row whose station is in none.
REGISTERS, NO_STATION = ("estacoes", "cidades", "estados"), "codigo_estacao: not registered"


@dataclass
class Loaded:
    """One dataset's rows on their way: parsed, without a registered station, what the merge did, rejected rows by reason, and relational verdicts."""

    resolved: int
    unmatched: int
    table: Written | None
    rejected: dict[str, int] = field(default_factory=dict)
    verdicts: dict[str, int] = field(default_factory=dict)


def registers(spark: SparkSession, states: DataFrame, cities: DataFrame, stations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(stations, cities, states) with ids from 1 on in the order of their codes."""
    state = dimension_keys(states.drop("id_estado"), "id_estado", ["codigo_ibge_estado"])
    city = dimension_keys(cities.join(state.select("id_estado", "sigla_estado"), "sigla_estado"), "id_cidade", ["codigo_ibge_cidade", "id_estado"])
    places = city.select("id_cidade", F.col("nome_cidade").alias("place"), F.col("sigla_estado").alias("state"))
    found = match_places(stations, places, "cidade", "sigla_estado", CITY_ALIASES)
    missing = found.where("id_cidade is null").count()
    if missing:
        raise ValueError(f"{missing} stations lie in no registered city")
    station = dimension_keys(found.select("codigo_origem", "nome_estacao", "status_estacao", "id_cidade"), "id_estacao", ["codigo_origem"])
    return station, city.select("id_cidade", "id_estado", "codigo_ibge_cidade", "nome_cidade"), state


def write_registers(spark: SparkSession, folder: str, registered: tuple[DataFrame, DataFrame, DataFrame]) -> None:
    """Snapshots of (stations, cities, states) in a folder's cadastros, published as one; an empty one is an error."""
    root = f"{folder.rstrip('/')}/cadastros"
    with leased(spark, root) as lease:
        seen, fresh = current(spark, root), new_folder()
        for name, table in zip(REGISTERS, registered, strict=True):
            table.coalesce(1).write.parquet(f"{root}/{fresh}/{name}")
            if spark.read.parquet(f"{root}/{fresh}/{name}").isEmpty():
                raise ValueError(f"the register {name} is empty")
        publish(spark, root, seen, {name: f"{fresh}/{name}" for name in REGISTERS}, lease)
        clean(spark, root, ("",), lambda content: [f.split("/")[0] for f in content.values()], lease)


def stored_registers(spark: SparkSession, folder: str, make: Callable[[], tuple[DataFrame, DataFrame, DataFrame]] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(stations, cities, states) from a folder's snapshots; the first time, make() gives what is written."""
    root = f"{folder.rstrip('/')}/cadastros"
    held = current(spark, root).content
    if not held:
        if make is None:
            raise ValueError(f"{root} has no registers")
        write_registers(spark, folder, make())
        held = current(spark, root).content
    found = tuple(spark.read.parquet(f"{root}/{held[name]}") for name in REGISTERS)
    for table, columns in zip(found, (("id_estacao", "codigo_origem", "id_cidade"), ("id_cidade", "nome_cidade"), ("id_estado", "sigla_estado")), strict=True):
        require_columns(table, columns, "a register")
    return found


def resolve(rows: DataFrame, rules: Contract, stations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with the contract's columns, rows that had no registered station)."""
    dim = stations.select(trimmed(F.col("codigo_origem")).alias("codigo_estacao"), "id_estacao", "id_cidade")
    found, unmatched = lookup(rows, dim, ["codigo_estacao"])
    return found.select(*rules.required, *[c for c in ("codigo_estacao", "file", "line", "value") if c in found.columns]), unmatched


def parse(spark: SparkSession, raw: str, rules: Contract, newest_first: bool = False) -> tuple[DataFrame, DataFrame]:
    """(first valid row of each natural key of all batches, in order of arrival; rejected rows with their reasons).

    newest_first puts the valid rows in order of their instants, for a reader who wants to see them; tables need no order.
    """
    # the lines are parsed once: whatever follows reads columns
    rows = written(flatten(read_lines(spark, raw, rules.name), rules.name), "flat")
    given = ["codigo_estacao", "data_leitura", *[k for k in rules.key if k in rows.columns], *rules.numeric]
    key = [k if k in rows.columns else "codigo_estacao" for k in rules.key]
    accepted, rejected = split(rows, row_rules(rules, list(dict.fromkeys(given))))
    first = keep_first(accepted, key, ["file", "line"])
    return first.orderBy(F.desc("data_leitura"), "file", "line") if newest_first else first, rejected


def _keep_rejected(rejected: DataFrame, unmatched: DataFrame, folder: str, name: str) -> dict[str, int]:
    """Write rejected rows beside the tables, a folder for each load; how many each reason rejected."""
    spark, path = rejected.sparkSession, f"{folder.rstrip('/')}/_rejected/{name}/{uuid.uuid4().hex}"
    both = rejected.unionByName(unmatched.withColumn("reasons", F.array(F.lit(NO_STATION))), allowMissingColumns=True)
    both.drop("line").write.parquet(path)
    return {r.reason: r.n for r in reason_counts(spark.read.parquet(path)).collect()}


def load(spark: SparkSession, raw: str, folder: str, stations: DataFrame, names: Sequence[str] | None = None, relational: str | None = None, legacy: Sequence[str] = ()) -> dict[str, Loaded]:
    """Merge every dataset's raw batches into its table; a second run adds nothing.

    With a folder for the relational model, rows go there first, and those that it accepts
    go on, as it holds them; legacy names old wide tables, which must hold no rows then.
    """
    done = {}
    for rules in [contract(n) for n in names or CONTRACTS]:
        accepted, rejected = parse(spark, raw, rules)
        rows, unmatched = resolve(accepted, rules, stations)
        reasons, verdicts = _keep_rejected(rejected, unmatched, folder, rules.name), {}
        if relational:
            approved, verdicts = load_frame(rows, rules, relational, ["file", "line"], References(stations, codes=[p[0] for p in PARAMETERS]), legacy)
            if "id_cidade" in rules.required:
                approved = approved.join(stations.select("id_estacao", "id_cidade"), "id_estacao")
            rows = approved.select(*rules.required)
        table = merge(rows.drop("file", "line", "codigo_estacao"), rules, folder, None)
        done[rules.name] = Loaded(table.received, reasons.get(NO_STATION, 0), table, reasons, verdicts)
    return done


def backfill(spark: SparkSession, raw: str, folder: str, stations: DataFrame, name: str, first: str, end: str, replace: bool = False, relational: str | None = None, legacy: Sequence[str] = ()) -> Loaded:
    """Load the days [first, end) again: by a merge, or by replacing those days.

    Days are replaced only if no row of the window, or without an instant, is rejected.
    With a folder for the relational model the window's rows go there first, and the
    days get all that it then holds of the window.
    """
    rules = contract(name)
    start, stop = exclusive_days(first, end)
    accepted, rejected = parse(spark, raw, rules)
    within = F.coalesce(half_open(F.col(rules.instant), start, stop), F.lit(True))
    rows, unmatched = resolve(accepted.where(within), rules, stations)
    reasons, verdicts = _keep_rejected(rejected.where(within), unmatched, folder, name), {}
    if relational:
        _, verdicts = load_frame(rows, rules, relational, ["file", "line"], References(stations, codes=[p[0] for p in PARAMETERS]), legacy)
        held = measures_of_period(*stored(spark, relational), rules, start, stop)
        rows = held.withColumnRenamed("chave_origem", "id_leitura_origem").join(stations.select("id_estacao", "id_cidade"), "id_estacao").select(*rules.required)
    rows = rows.drop("file", "line", "codigo_estacao")
    if not replace:
        done = merge(rows, rules, folder)
    elif reasons or verdicts.get("reject"):
        raise ValueError(f"rows were rejected ({reasons or verdicts}); the days stay as they are")
    else:
        done = rebuild(lambda: rows, rules, folder, *(datetime(d.year, d.month, d.day, tzinfo=timezone.utc) for d in (start, stop)))
    return Loaded(done.received, reasons.get(NO_STATION, 0), done, reasons, verdicts)


def run(spark: SparkSession, raw: str, folder: str, gold: str, registered: tuple[DataFrame, DataFrame, DataFrame], first: str | None = None, last: str | None = None, only_gold: bool = False, relational: str | None = None, legacy: Sequence[str] = ()) -> dict[str, int]:
    """Raw batches to tables (unless only_gold) to the star schema: rows resolved by dataset, and facts."""
    counts = {} if only_gold else {name: done.resolved for name, done in load(spark, raw, folder, registered[0], relational=relational, legacy=legacy).items()}
    tables = publish_star(read_measures(spark, folder, first, last), registered, gold, folder)
    return counts | {"facts": tables["Fato_Medicoes"].count()}
