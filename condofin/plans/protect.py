"""W16 encrypt, W17 mask, W18 decrypted view of personal data.

Parquet has no UPDATE: each step returns new DataFrames (and
:func:`protect_tables` can write them to a new location and read them back,
which is how a job should persist ciphertext - recomputing an encryption
gives other bytes).

* W16: live persons get ``dni_enc, email_enc, telefono_enc, cbu_cvu_enc``
  (AES-256-GCM of the text form; ints are encrypted as their decimal text);
  live payments with an account get ``cbu_cvu_origen_enc``.  Deleted rows keep
  NULL ciphertext.  ``token_key`` adds keyed SHA-256 tokens (``*_tok``) of
  the account columns for hash joins without decryption.
* W17: live persons: dni = 0, email = '[CIFRADO]', telefono = 0, account =
  ``ENC-`` + 18-digit row number in ``persona_id`` order among live persons;
  every live payment's account likewise in ``pago_id`` order (also those
  whose account was NULL and so not encrypted).  The two sequences are
  independent, so masked values of person 1 and payment 1 are equal - they
  are not a join key (account matching refuses them).
* W18: the person table with the four columns decrypted and cast back; no
  live filter; NULL where there is no ciphertext.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.crypto import decrypt_text, encrypt_text, token
from ..model import Tables
from ..operators.windows import dense_row_number
from ..sources.tables_io import log_append, log_entries, rewrite_partitions

# Mask text and account-mask format.
MASKED_EMAIL = "[CIFRADO]"
MASK_PREFIX = "ENC-"
MASK_DIGITS = 18

PERSON_PROTECTED = ("dni", "email", "telefono", "cbu_cvu")


def encrypt_columns(tables: Tables, key: Column, token_key: Column | None = None) -> Tables:
    """Ciphertext columns beside the clear ones (live rows only)."""
    alive = ~F.col("borrado")
    per = tables.persona.withColumns({
        f"{c}_enc": F.when(alive, encrypt_text(F.col(c), key)) for c in PERSON_PROTECTED})
    pay = tables.pago.withColumn(
        "cbu_cvu_origen_enc",
        F.when(alive & F.col("cbu_cvu_origen").isNotNull(), encrypt_text(F.col("cbu_cvu_origen"), key)))
    if token_key is not None:
        per = per.withColumn("cbu_cvu_tok", F.when(alive, token(F.col("cbu_cvu"), token_key)))
        pay = pay.withColumn("cbu_cvu_origen_tok",
                             F.when(alive & F.col("cbu_cvu_origen").isNotNull(),
                                    token(F.col("cbu_cvu_origen"), token_key)))
    return tables.replace(persona=per, pago=pay)


def _mask(rn: Column) -> Column:
    return F.concat(F.lit(MASK_PREFIX), F.lpad(rn.cast("string"), MASK_DIGITS, "0"))


def _row_numbers(df: DataFrame, id_col: str) -> DataFrame:
    """``id_col`` of the live rows and their row number in its order.  Only the
    ids are sorted and written; no other column leaves its table."""
    return dense_row_number(df.filter(~F.col("borrado")).select(id_col), id_col, "rn__mask")


def mask_persons(persons: DataFrame) -> DataFrame:
    """W17 on persons: overwrite the clear personal columns of live rows."""
    alive = ~F.col("borrado")
    numbers = _row_numbers(persons, "persona_id")
    return persons.join(numbers, "persona_id", "left").withColumns({
        "dni": F.when(alive, F.lit(0).cast(persons.schema["dni"].dataType)).otherwise(F.col("dni")),
        "email": F.when(alive, F.lit(MASKED_EMAIL)).otherwise(F.col("email")),
        "telefono": F.when(alive, F.lit(0).cast(persons.schema["telefono"].dataType)).otherwise(F.col("telefono")),
        "cbu_cvu": F.when(alive, _mask(F.col("rn__mask"))).otherwise(F.col("cbu_cvu")),
    }).select(*persons.columns)


def mask_payments(payments: DataFrame) -> DataFrame:
    """W17 on payments: overwrite the account of live rows."""
    alive = ~F.col("borrado")
    numbers = _row_numbers(payments, "pago_id")
    return payments.join(numbers, "pago_id", "left").withColumn(
        "cbu_cvu_origen", F.when(alive, _mask(F.col("rn__mask"))).otherwise(F.col("cbu_cvu_origen"))
    ).select(*payments.columns)


def mask_columns(tables: Tables) -> Tables:
    """W17 on both tables."""
    return tables.replace(persona=mask_persons(tables.persona), pago=mask_payments(tables.pago))


def decrypt_view(persons: DataFrame, key: Column, view_name: str | None = None) -> DataFrame:
    """Persons with decrypted contact data (optionally as a temp view)."""
    out = persons.select(
        "persona_id", "nombre", "apellido",
        decrypt_text(F.col("dni_enc"), key).try_cast("bigint").alias("dni"),
        decrypt_text(F.col("email_enc"), key).alias("email"),
        decrypt_text(F.col("telefono_enc"), key).try_cast("bigint").alias("telefono"),
        decrypt_text(F.col("cbu_cvu_enc"), key).alias("cbu_cvu"),
    )
    if view_name:
        out.createOrReplaceTempView(view_name)
    return out


def protect_tables(tables: Tables, key: Column, token_key: Column | None = None,
                   path: str | None = None) -> Tables:
    """W16 then W17.  With ``path``, persons and payments are written there
    (Parquet, new folders) and read back, so later jobs see fixed bytes."""
    prot = mask_columns(encrypt_columns(tables, key, token_key))
    if path is None:
        return prot
    spark = prot.persona.sparkSession
    base = path.rstrip("/")
    prot.persona.write.mode("overwrite").parquet(f"{base}/persona")
    prot.pago.write.mode("overwrite").parquet(f"{base}/pago")
    return prot.replace(persona=spark.read.parquet(f"{base}/persona"),
                        pago=spark.read.parquet(f"{base}/pago"))


# ------------------------------------------------- protection of stored tables
#: Stored tables: id, protected account column, clear columns, partition column.
_STORED = {"persona": ("persona_id", "cbu_cvu", "tramo"), "pago": ("pago_id", "cbu_cvu_origen", "mes")}
#: Persons are stored in ranges of so many ids.
PERSONS_IN_RANGE = 1_000_000
LEDGER = "numeracion"


def store_for_protection(tables: Tables, base: str, names: tuple[str, ...] = ("persona", "pago")) -> None:
    """Append persons by ranges of ids and payments by month, with the columns
    of ciphertext and tokens still NULL: what :func:`protect_stored` updates."""
    base = base.rstrip("/")
    none = {"string": F.lit(None).cast("string"), "binary": F.lit(None).cast("binary")}
    per = tables.persona.withColumns({f"{c}_enc": none["binary"] for c in PERSON_PROTECTED} | {"cbu_cvu_tok": none["string"]})
    pay = tables.pago.withColumns({"cbu_cvu_origen_enc": none["binary"], "cbu_cvu_origen_tok": none["string"]})
    parts = {"persona": per.withColumn("tramo", F.floor(F.col("persona_id") / PERSONS_IN_RANGE).cast("bigint")),
             "pago": pay.withColumn("mes", F.date_format("fecha", "yyyy-MM"))}
    for name in names:
        column = _STORED[name][2]
        parts[name].repartition(column).write.mode("append").partitionBy(column).parquet(f"{base}/{name}")


def _clear(table: str) -> Column:
    """Live rows that are not masked yet."""
    return ~F.col("borrado") & ~F.coalesce(F.col(_STORED[table][1]).startswith(MASK_PREFIX), F.lit(False))


def protect_stored(spark: SparkSession, base: str, key: Column, token_key: Column) -> dict[str, list]:
    """W16 and W17 on stored tables, batch after batch.

    Only partitions that hold clear live rows are read and rewritten; rows that
    are protected keep their bytes.  Mask numbers of a batch continue after
    those given before: a ledger beside the tables has one small entry for each
    batch (first number, how many), written before the rows are, so a run that
    stops half-way leaves a gap and never gives a number twice.  Returns the
    partitions rewritten, by table."""
    base, out = base.rstrip("/"), {}
    for table, (id_col, account, partition) in _STORED.items():
        def change(rows: DataFrame, table=table, id_col=id_col, account=account) -> DataFrame:
            clear = _clear(table)
            # numbers of the ids, written once: the count and the join see the same
            numbers = dense_row_number(rows.where(clear).select(id_col), id_col, "rn__mask")
            folder = f"{base}/{LEDGER}/{table}"
            entries = [json.loads(e) for e in log_entries(spark, folder)]
            start = sum(e["filas"] for e in entries)
            log_append(spark, folder, json.dumps({"desde": start + 1, "filas": numbers.count()}), len(entries))
            protected = (PERSON_PROTECTED if table == "persona" else (account,))
            columns = {f"{c}_enc": F.when(clear & F.col(c).isNotNull(), encrypt_text(F.col(c), key)).otherwise(F.col(f"{c}_enc"))
                       for c in protected}
            columns[f"{account}_tok"] = F.when(clear & F.col(account).isNotNull(), token(F.col(account), token_key)) \
                .otherwise(F.col(f"{account}_tok"))
            columns[account] = F.when(clear, _mask(F.lit(start) + F.col("rn__mask"))).otherwise(F.col(account))
            if table == "persona":
                columns |= {c: F.when(clear, F.lit(0).cast(rows.schema[c].dataType)).otherwise(F.col(c)) for c in ("dni", "telefono")}
                columns["email"] = F.when(clear, F.lit(MASKED_EMAIL)).otherwise(F.col("email"))
            return rows.join(numbers, id_col, "left").withColumns(columns)
        out[table] = rewrite_partitions(spark, f"{base}/{table}", partition, _clear(table), change)
    return out


#: Views of :func:`open_views`.
PERSONS_VIEW, KEY_VIEW = "persona_descifrada", "llave_abierta"


def open_views(persons: DataFrame, key: bytes | None) -> None:
    """W18 as a SQL view: ``persona_descifrada`` decrypts with the key that the
    view ``llave_abierta`` holds when it is read, not when it was made; with no
    key (:func:`close_key`) the protected columns are NULL."""
    spark = persons.sparkSession
    _key_view(spark, key)
    persons.createOrReplaceTempView("persona_cifrada")
    columns = {"dni": "bigint", "email": "string", "telefono": "bigint", "cbu_cvu": "string"}
    clear = ", ".join(f"try_cast(CAST(try_aes_decrypt({c}_enc, (SELECT k FROM {KEY_VIEW}), 'GCM') AS STRING) AS {kind}) AS {c}"
                      for c, kind in columns.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {PERSONS_VIEW} AS "
              f"SELECT persona_id, nombre, apellido, {clear} FROM persona_cifrada")


def _key_view(spark: SparkSession, key: bytes | None) -> None:
    spark.createDataFrame([(None if key is None else bytearray(key),)], "k binary").createOrReplaceTempView(KEY_VIEW)


def close_key(spark: SparkSession) -> None:
    _key_view(spark, None)
