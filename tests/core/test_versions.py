"""Leases of several writers, also of other processes, and tables whose writers are killed between steps."""

import os
import signal
import subprocess
import sys
import threading
import time
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from envlake.domain import WATER
from envlake.plans import medallion
from envlake.sources import tables, versions

from test_tables import content, utc, water

REPO = str(Path(__file__).resolve().parents[2])
#: Another driver: takes the lease, says so, and goes on when its standard input says so.
OTHER = f"""
import sys, time
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
from envlake.sources import versions
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
root, term = sys.argv[1], float(sys.argv[2])
with versions.leased(spark, root, term=term) as lease:
    seen = versions.current(spark, root)
    print("held", lease.token, flush=True)
    sys.stdin.readline()
    try:
        versions.publish(spark, root, seen, {{"by": "other"}}, lease)
        print("published", flush=True)
    except versions.LeaseLost:
        print("lost", flush=True)
"""


def other(root, term):
    p = subprocess.Popen([sys.executable, "-c", OTHER, root, str(term)], stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=subprocess.DEVNULL, text=True, start_new_session=True)
    assert p.stdout.readline().startswith("held")
    return p


def end(p):
    try:
        os.killpg(p.pid, signal.SIGKILL)
    except ProcessLookupError:
        pass
    p.wait()


def test_one_writer_at_a_time(spark, tmp_path):
    order = []

    def write(name):
        with versions.leased(spark, str(tmp_path / "t")) as lease:
            order.append((name, lease.token))
            threading.Event().wait(0.2)
            order.append((name, lease.token))

    threads = [threading.Thread(target=write, args=(n,)) for n in "abc"]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert [t for _, t in order] == [1, 1, 2, 2, 3, 3] and all(a[0] == b[0] for a, b in zip(order[::2], order[1::2], strict=True))
    with versions.leased(spark, str(tmp_path / "t")) as lease, pytest.raises(TimeoutError), versions.leased(spark, str(tmp_path / "t"), timeout=0.3):
        pass
    assert lease.token == 4


def test_a_killed_process_gives_its_lease_back_at_once(spark, tmp_path):
    root = str(tmp_path / "t")
    p = other(root, 600)
    end(p)
    began = time.monotonic()
    with versions.leased(spark, root, timeout=30, term=600) as lease:
        assert lease.token == 2 and time.monotonic() - began < 10


def test_a_live_process_keeps_its_lease_beyond_its_term(spark, tmp_path):
    root = str(tmp_path / "t")
    p = other(root, 1.0)
    try:
        with pytest.raises(TimeoutError), versions.leased(spark, root, timeout=5, term=1.5):
            pass
        p.stdin.write("go\n")
        p.stdin.flush()
        assert p.stdout.readline() == "published\n"
    finally:
        end(p)
    assert versions.current(spark, root).content == {"by": "other"}


def test_a_stopped_process_loses_its_lease_and_can_not_publish(spark, tmp_path):
    root = str(tmp_path / "t")
    p = other(root, 1.0)
    try:
        os.killpg(p.pid, signal.SIGSTOP)
        with versions.leased(spark, root, timeout=30, term=1.5) as lease:
            done = versions.publish(spark, root, versions.current(spark, root), {"by": "this"}, lease)
            os.killpg(p.pid, signal.SIGCONT)
            p.stdin.write("go\n")
            p.stdin.flush()
            assert p.stdout.readline() == "lost\n"
        assert done.version == 1
    finally:
        end(p)
    assert versions.current(spark, root).content == {"by": "this"}
    with versions.leased(spark, root) as lease:
        assert lease.token == 3  # what the stopped one did at its end freed nobody's lease
        with pytest.raises(versions.LeaseLost):
            versions.publish(spark, root, versions.Snapshot(0, {}), {"by": "late"}, lease)


class Killed(BaseException):
    pass


STEPS = ["_write_days", "_index", "publish", "put_new", "clean", "_manifest"]


@pytest.mark.parametrize("write, step, when", [*[("merge", s, w) for s in STEPS for w in ("before", "after")], *[("rebuild", s, "after") for s in ("_write_days", "_index", "publish")]])
def test_a_write_killed_at_any_step_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, write, step, when):
    folder = str(tmp_path)
    monkeypatch.setattr(tables, "CLEAN_EVERY", 1)
    tables.merge(water(spark, ("a", "2026-05-20T10:00:00", 1.0), ("b", "2026-05-21T10:00:00", 2.0)), WATER, folder)
    old = content(spark, folder)
    reader = tables.read_table(spark, f"{folder}/qualidade_agua")
    change = water(spark, ("c", "2026-05-20T11:00:00", 3.0), ("d", "2026-05-22T11:00:00", 4.0)) if write == "merge" else water(spark, ("c", "2026-05-20T11:00:00", 3.0))

    def run():
        if write == "merge":
            return tables.merge(change, WATER, folder)
        return tables.rebuild(lambda: change, WATER, folder, utc("2026-05-20"), utc("2026-05-22"))

    new = sorted([*old, ("c", "2026-05-20", 3.0), ("d", "2026-05-22", 4.0)]) if write == "merge" else [("c", "2026-05-20", 3.0)]
    holder = versions if step == "put_new" else tables
    real = getattr(holder, step)
    state = {"armed": True}

    def killed(*args, **more):
        if step == "put_new" and "/_log/" not in args[1] or not state["armed"]:
            return real(*args, **more)
        state["armed"] = False
        if when == "after":
            real(*args, **more)
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(holder, step, killed)
        m.setattr(tables, "remove", lambda *_: None)  # a killed driver tidies nothing
        with pytest.raises(Killed):
            run()
    published = step in ("clean", "_manifest") or step in ("publish", "put_new") and when == "after"
    assert content(spark, folder) == (new if published else old)
    assert reader.count() == len(old)
    run()
    assert content(spark, folder) == new
    with versions.leased(spark, f"{folder}/qualidade_agua") as lease:
        versions.clean(spark, f"{folder}/qualidade_agua", ("", "_keys"), tables._used, lease, retention=0.0)
    left = {p.name for p in (tmp_path / "qualidade_agua").iterdir() if p.name.startswith(versions.PREFIX)}
    assert left == {f.split("/")[0] for f in tables._used(versions.current(spark, f"{folder}/qualidade_agua").content) if not f.startswith("_keys")}
    assert content(spark, folder) == new


def test_a_merge_reads_the_keys_of_days_that_may_have_them(spark, tmp_path, monkeypatch):
    folder, path = str(tmp_path), str(tmp_path / "qualidade_agua")
    days = [f"2026-05-{d:02}" for d in range(1, 11)]
    tables.merge(water(spark, *[(f"k{d}{i}", f"{d}T10:00:00", 1.0) for d in days for i in range(3)]), WATER, folder)
    read, real = [], tables._read
    monkeypatch.setattr(tables, "_read", lambda spark, path, held, days=None: (read.append(real(spark, path, held, days)), read[-1])[1])
    tables.merge(water(spark, ("new", "2026-05-11T10:00:00", 1.0)), WATER, folder)
    assert read == []  # no key was found in the index: no file of the table is read
    done = tables.merge(water(spark, ("k2026-05-030", "2026-05-20T10:00:00", 5.0), ("k2026-05-071", "2026-05-20T10:00:00", 5.0), ("other", "2026-05-20T10:00:00", 5.0)), WATER, folder)
    assert done.written == 1
    files = {f.split(f"{tables.DAY}=")[1][:10] for df in read for f in df.inputFiles()}
    assert files == {"2026-05-03", "2026-05-07"}
    monkeypatch.undo()
    with pytest.raises(ValueError, match="day outside"):
        tables.rebuild(lambda: water(spark, ("k2026-05-030", "2026-05-04T10:00:00", 5.0)), WATER, folder, utc("2026-05-04"), utc("2026-05-05"))
    tables.rebuild(lambda: water(spark, ("fresh", "2026-05-03T10:00:00", 5.0)), WATER, folder, utc("2026-05-03"), utc("2026-05-04"))
    # a key of a replaced day is free again
    assert tables.merge(water(spark, ("k2026-05-030", "2026-05-20T10:00:00", 5.0)), WATER, folder).written == 1
    assert tables.read_table(spark, path).count() == 31


def test_a_folder_by_day_without_a_log_is_taken_over(spark, tmp_path):
    folder, path = str(tmp_path), str(tmp_path / "qualidade_agua")
    plain = water(spark, ("a", "2026-05-20T10:00:00", 1.0), ("b", "2026-05-21T10:00:00", 2.0))
    plain.withColumn(tables.DAY, F.to_date("data_leitura")).write.partitionBy(tables.DAY).parquet(path)
    assert tables.has_table(spark, path) and len(content(spark, folder)) == 2
    done = tables.merge(water(spark, ("a", "2026-05-25T10:00:00", 9.0), ("c", "2026-05-20T12:00:00", 3.0)), WATER, folder)
    assert done.written == 1
    assert content(spark, folder) == [("a", "2026-05-20", 1.0), ("b", "2026-05-21", 2.0), ("c", "2026-05-20", 3.0)]
    assert [r.id_leitura_origem for r in tables.read_days(spark, path, datetime(2026, 5, 21).date()).collect()] == ["b"]


def test_days_and_the_index_are_put_together(spark, tmp_path, monkeypatch):
    folder, path = str(tmp_path), str(tmp_path / "qualidade_agua")
    monkeypatch.setattr(tables, "MOST_FOLDERS", 3)
    monkeypatch.setattr(tables, "CLEAN_EVERY", 1)
    monkeypatch.setattr(tables, "clean", lambda *args: versions.clean(*args, retention=0.0))
    for i in range(9):
        assert tables.merge(water(spark, (f"k{i}", "2026-05-20T10:00:00", 1.0), ("k0", "2026-05-21T10:00:00", 1.0)), WATER, folder).written == 1
    held = versions.current(spark, path).content
    assert len(held["days"]["2026-05-20"]) <= 4 and len(held["index"]) <= 4
    assert len(content(spark, folder)) == 9
    assert len(list((tmp_path / "qualidade_agua" / "_keys").iterdir())) == len(held["index"])


def test_registers_are_replaced_as_one(spark, tmp_path, monkeypatch):
    make = lambda n: tuple(spark.createDataFrame([(n, "x", n)], s) for s in ("id_estacao bigint, codigo_origem string, id_cidade bigint", "id_cidade bigint, nome_cidade string, id_estado bigint", "id_estado bigint, sigla_estado string, n bigint"))
    folder = str(tmp_path)
    medallion.write_registers(spark, folder, make(1))
    for step in ("publish", "clean"):
        with monkeypatch.context() as m:
            m.setattr(medallion, step, lambda *_: (_ for _ in ()).throw(OSError("killed")))
            with pytest.raises(OSError):
                medallion.write_registers(spark, folder, make(2))
        seen = {t.first()[0] for t in medallion.stored_registers(spark, folder)}
        assert seen == ({1} if step == "publish" else {2})
    assert datetime.now(timezone.utc)
