import base64
import hashlib
import hmac
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from envlake.domain import RAW_WATER
from envlake.functions import numbers, personal, raw_json, text, times


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


def test_instants(spark):
    at = lambda v, need=False: one(spark, times.instant(F.col("x"), need), v)
    assert at("2026-05-19T21:00:00-03:00") == datetime(2026, 5, 20) == at("2026-05-20T00:00:00Z") == at("2026-05-20 00:00:00")
    assert at("2026") is None and at("ontem") is None and at(None) is None and at("2026-05-20T00:00:00", True) is None
    assert times.inclusive_days("2026-01-01", "2026-01-02") == (datetime(2026, 1, 1), datetime(2026, 1, 3))
    for bad in ("2026-1-1", "20260101", "x"):
        with pytest.raises(ValueError):
            times.strict_day(bad)
    with pytest.raises(ValueError):
        times.exclusive_days("2026-01-02", "2026-01-02")
    with pytest.raises(ValueError):
        times.utc_midnight(datetime(2026, 1, 1))
    assert times.utc_midnight(datetime(2026, 1, 1, tzinfo=timezone.utc)).day == 1


def test_days_and_keys_are_in_utc_whatever_the_session_says(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        df = spark.sql("select timestamp'2026-05-20T00:30:00Z' as t, 7 as s")
        row = df.select(times.utc_day(F.col("t")).alias("d"), times.natural_key(F.col("s"), F.col("t")).alias("k"), times.half_open(F.col("t"), *times.inclusive_days("2026-05-20", "2026-05-20")).alias("h"), (times.instant(F.lit("2026-05-20T00:30:00")) == F.col("t")).alias("i")).first()
        assert (str(row.d), row.k, row.h, row.i) == ("2026-05-20", "7|2026-05-20T00:30:00.000000+00:00", True, True)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_strict_ids(spark):
    assert one(spark, numbers.strict_id(F.col("x")), "7") == 7 and one(spark, numbers.strict_id(F.col("x")), None) is None
    for bad in ("x", "1.5", "-1", ""):
        with pytest.raises(Exception, match="no positive whole number"):
            one(spark, numbers.strict_id(F.col("x")), bad)


def test_numbers(spark):
    read = lambda v: one(spark, numbers.number(F.col("x")), v)
    assert read(" 5.2 ") == 5.2 and read("1e3") == 1000 and read("bad") is None and read("NaN") is None and read("1d") is None and read("true") is None
    exact = lambda v: one(spark, numbers.exact_decimal(F.col("x")).cast("string"), v)
    assert exact("1.5") == "1.500000" and exact("1.1234567") is None and exact("0.30000000000000004") is None and exact("1234567890123") is None
    assert one(spark, numbers.positive_id(F.col("x")), "3.0") == 3 and one(spark, numbers.positive_id(F.col("x")), "-1") is None


def test_text(spark):
    assert one(spark, text.match_key(F.col("x")), " São João-d'Oeste ") == "saojoaodoeste"
    assert [one(spark, text.match_key(F.col("x")), v) for v in ("Štětí", "Straße ①", "Łódź", "ﬁn", None)] == ["steti", "strasse1", "łodz", "fin", None]
    assert one(spark, text.safe_source(F.col("x")), "https://me:pw@h.example/a/b?token=1#f") == "h.example/a/b"
    assert one(spark, text.station_label(F.lit("N"), F.col("x"), F.lit("Ativa")), None) == "[Desativado] N -"
    assert [one(spark, text.active_flag(F.col("x"), ("ativo",), ("desativado",)), v) for v in (" Ativo", "desativado", "?", None)] == [1, 0, 0, None]


@pytest.mark.parametrize(
    "change, reason",
    [
        ('"id":"a"', None), ('"id":null', "id: missing"), ('"id":7', "id: not a text"), ('"id":"  "', "id: blank"),
    ],
)
def test_contract_of_ids(spark, change, reason):
    body = '"estacao_id":"e","timestamp":"2026-01-01T00:00:00Z","extra":1,"qualidade_agua":{' + ",".join(f'"{p.split(".")[1]}":{{"valor":1}}' for p, n in RAW_WATER if n == "number") + "}"
    assert one(spark, raw_json.first_violation(F.try_parse_json("x"), RAW_WATER), "{" + change + "," + body + "}") == reason


def test_contract_of_numbers_and_instants(spark):
    check = lambda record: one(spark, raw_json.first_violation(F.try_parse_json("x"), [("t", "instant"), ("a.v", "number")]), record)
    assert check('{"t":"2026-01-01T00:00:00Z","a":{"v":7}}') is None
    assert check('{"t":"ontem","a":{"v":7}}') == "t: not an ISO instant"
    assert check('{"t":"2026-01-01T00:00:00","a":{"v":7}}') == "t: without a time zone"
    for value, reason in (('"7"', "not a number"), ("true", "not a number"), ("null", "missing"), ("{}", "not a number")):
        assert check('{"t":"2026-01-01T00:00:00Z","a":{"v":' + value + "}}") in (f"a.v: {reason}", "a.v: not a number")
    assert check('{"t":"2026-01-01T00:00:00Z"}') == "a.v: missing"
    assert check("[1]") == check(None) == "record: not an object"


def test_cpf(spark):
    digits = lambda v: one(spark, personal.cpf_digits(F.col("x")), v)
    assert digits("529.982.247-25") == "52998224725"
    assert digits("529.982.247-24") is None and digits("111.111.111-11") is None and digits("123") is None and digits(None) is None


def test_hmac_equals_the_library(spark):
    for key in (b"k", b"k" * 100):
        assert one(spark, personal.hmac_sha256(F.col("x"), key), "texto é") == hmac.new(key, "texto é".encode(), hashlib.sha256).hexdigest()
    for key in (b"", b"  ", b"changeme"):
        with pytest.raises(ValueError):
            personal.hmac_sha256(F.col("x"), key)


def test_fernet_public_vector(spark):
    key = "cw_0x689RpI-jtRR7oE8h_eQsKImvJapLeSbXpwF4e4="
    token = one(spark, personal.encrypt_name(F.col("x"), key, at=F.lit(499162800).cast("bigint"), iv=F.lit(bytes(range(16)))), "hello")
    assert token == "gAAAAAAdwJ6wAAECAwQFBgcICQoLDA0ODy021cpGVWKZ_eEwCGM4BLLF_5CV9dOPmrhuVUPgJobwOz7JcbmrR64jVmpU4IwqDA=="
    read = lambda t, **k: one(spark, personal.read_names(F.col("x"), key, **({"principal": "loader", "authorize": lambda p, a: True} | k)), t)
    assert read(token) == "hello"
    assert read(token[:-6] + "AAAA==") is None and read("no token") is None
    with pytest.raises(PermissionError):
        read(token, authorize=lambda p, a: False)
    with pytest.raises(PermissionError):
        read(token, principal="a b")
    a, b = (one(spark, personal.encrypt_name(F.col("x"), key), " Ana ") for _ in range(2))
    assert a != b and read(a) == "Ana" and base64.urlsafe_b64decode(a)[0] == 0x80
    assert one(spark, personal.encrypt_name(F.col("x"), key), "  ") is None
