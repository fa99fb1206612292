"""Column protection expressions: AES-256-GCM ciphertext and keyed tokens.

The key is a 32-byte value supplied by configuration
(``spark.condofin.protect.secretKey``, hex).  It enters plans as a scalar
subquery over a one-row table, so no literal holds it and neither ``explain``
in any mode nor the event log can print it.  Tokens use a key of their own.
Never encrypt a literal: Catalyst folds it once and every row would share one
ciphertext - always encrypt columns.
"""

from __future__ import annotations

import hashlib
import hmac
import os

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# "secret" in the name: Spark's default spark.redaction.regex hides the value
# in event logs and environment listings
KEY_CONF = "spark.condofin.protect.secretKey"
TOKEN_KEY_CONF = "spark.condofin.protect.tokenSecretKey"


#: Random key of each application that has none configured.
_OWN_KEYS: dict[str, str] = {}


def session_key_hex(spark: SparkSession, passing: bool = False) -> str:
    """The configured key; a local-mode session without one gets a fresh
    random key (results of decrypt-mode jobs do not depend on the key).

    On a cluster the key must be configured, or what is stored could never be
    read again.  With ``passing``, for ciphertext that doesn't outlive the
    application (it stays in a plan or in scratch tables), a session on any
    master gets the random key, the same one until the application ends.

    Configure the key when the session is built: Spark redacts launch settings
    in event logs, but logs what ``spark.conf.set`` adds later as it is.
    """
    hexkey = spark.conf.get(KEY_CONF, None)
    if not hexkey:
        if not (passing or spark.sparkContext.master.startswith("local")):
            raise RuntimeError(f"{KEY_CONF} must be set")
        hexkey = _OWN_KEYS.setdefault(spark.sparkContext.applicationId, os.urandom(32).hex())
    if len(bytes.fromhex(hexkey)) != 32:
        raise ValueError("AES-256 needs a 32-byte key")
    return hexkey


def _one_value(spark: SparkSession, value: bytes) -> Column:
    """A binary value as a column that plans show only as a subquery."""
    schema = T.StructType([T.StructField("k", T.BinaryType())])
    return spark.createDataFrame([(bytearray(value),)], schema).scalar()


def key_column(spark: SparkSession, passing: bool = False) -> Column:
    """The AES key as a binary column (``passing``: see :func:`session_key_hex`)."""
    return _one_value(spark, bytes.fromhex(session_key_hex(spark, passing)))


def token_key_column(spark: SparkSession, passing: bool = False) -> Column:
    """The token key as a binary column: from ``TOKEN_KEY_CONF``, else derived
    one-way from the AES key, so that a token never depends on that key itself."""
    own = spark.conf.get(TOKEN_KEY_CONF, None)
    value = bytes.fromhex(own) if own else hmac.new(
        bytes.fromhex(session_key_hex(spark, passing)), b"account token", hashlib.sha256).digest()
    return _one_value(spark, value)


def encrypt_text(c: Column, key: Column) -> Column:
    return F.aes_encrypt(c.cast("string"), key, F.lit("GCM"))


def decrypt_text(c: Column, key: Column) -> Column:
    """Decrypted text, NULL when the value cannot be decrypted."""
    return F.try_aes_decrypt(c, key, F.lit("GCM")).cast("string")


def token(c: Column, token_key: Column) -> Column:
    """Keyed SHA-256 token of the right-trimmed text (equality only)."""
    return F.sha2(F.concat(token_key, F.rtrim(c.cast("string")).cast("binary")), 256)
