"""Personal data: checking, pseudonyms, encryption and authorised reading.

Keys are prepared on the driver; everything else is built-in expressions. Don't
log plans that hold these expressions: key literals show in them.
"""

from __future__ import annotations

import base64
import logging
import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

log = logging.getLogger(__name__)
PRINCIPAL = re.compile(r"^[A-Za-z0-9_.@-]{1,64}$")
PLACEHOLDERS = ("change", "changeme", "replace", "your", "<", "xxx")


def cpf_digits(c: Column) -> Column:
    """The 11 digits of a valid CPF, else null.

    Each check digit is the weighted sum of the digits before it, times ten,
    modulo 11, with 10 read as 0; digits that are all equal are not valid.
    """
    digits = F.regexp_replace(c, r"\D", "")

    def check(n: int) -> Column:
        terms = [F.substring(digits, i + 1, 1).try_cast("int") * (n + 1 - i) for i in range(n)]
        return (sum(terms[1:], terms[0]) * 10) % 11 % 10

    valid = (F.length(digits) == 11) & ~digits.rlike(r"^(\d)\1{10}$") & (check(9) == F.substring(digits, 10, 1).try_cast("int")) & (check(10) == F.substring(digits, 11, 1).try_cast("int"))
    return F.when(valid, digits)


def _required(key: bytes) -> bytes:
    if not key or not key.strip():
        raise ValueError("the key is empty")
    if key.strip().lower().startswith(tuple(p.encode() for p in PLACEHOLDERS)):
        raise ValueError("the key is a placeholder")
    return key


def _hmac(message: Column, key: bytes) -> Column:
    import hashlib

    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(x ^ pad for x in block)) for pad in (0x36, 0x5C))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, message), 256))), 256)


def hmac_sha256(message: Column, key: bytes) -> Column:
    """HMAC-SHA-256 of a text or binary, in lower-case hex."""
    return _hmac(message.cast("binary"), _required(key))


def cpf_pseudonym(c: Column, key: bytes) -> Column:
    """The keyed digest of a CPF; null where the CPF is not valid."""
    return hmac_sha256(cpf_digits(c), key)


def _keys(token_key: str) -> tuple[bytes, bytes]:
    key = base64.urlsafe_b64decode(_required(token_key.encode()))
    if len(key) != 32:
        raise ValueError("the encryption key needs 32 bytes")
    return key[:16], key[16:]


def encrypt_name(name: Column, token_key: str, at: Column | None = None, iv: Column | None = None) -> Column:
    """A Fernet token of a trimmed name: version, time, AES-128-CBC with a random start, HMAC, in URL-safe base64."""
    sign, secret = _keys(token_key)
    text = F.trim(name)
    seconds = F.unhex(F.lpad(F.hex(F.coalesce(at, F.unix_timestamp()) if at is not None else F.unix_timestamp()), 16, "0"))
    start = iv if iv is not None else F.unhex(F.replace(F.uuid(), F.lit("-"), F.lit("")))
    body = F.concat(F.lit(b"\x80"), seconds, F.aes_encrypt(text.cast("binary"), F.lit(secret), F.lit("CBC"), F.lit("PKCS"), start))
    token = F.base64(F.concat(body, F.unhex(_hmac(body, sign))))
    return F.when(text != "", F.translate(F.regexp_replace(token, r"\s", ""), "+/", "-_"))


def read_names(ciphertext: Column, token_key: str, *, principal: str, authorize: Callable[[str, str], bool], action: str = "read_name") -> Column:
    """The names in tokens, for a principal that authorize allows; null where a token is not authentic.

    Every attempt is logged, without personal data.
    """
    if not PRINCIPAL.match(principal or ""):
        log.warning("names: principal refused")
        raise PermissionError("no such principal")
    if authorize(principal, action) is not True:
        log.warning("names: %s refused for %s", action, principal)
        raise PermissionError(f"{principal} may not {action}")
    log.info("names: %s allowed for %s", action, principal)
    sign, secret = _keys(token_key)
    raw = F.try_to_binary(F.translate(ciphertext, "-_", "+/"), F.lit("base64"))
    body = F.substring(raw, F.lit(1), F.length(raw) - 32)
    tag = F.substring(raw, F.length(raw) - 31, F.lit(32))
    plain = F.try_aes_decrypt(F.substring(raw, F.lit(10), F.length(raw) - 41), F.lit(secret), F.lit("CBC"), F.lit("PKCS"))
    return F.when(F.lower(F.hex(tag)) == _hmac(body, sign), plain.cast("string"))
