"""W13 payment -> person by account, W14 tenure valid on a date.

Account matching
----------------
Payments name the paying account; people own accounts.  Three modes:

* ``clear``   - equality of right-trimmed clear text.  Masked values
  (``ENC-`` + sequence, written by :func:`~condofin.plans.protect.mask_columns`)
  are refused: person 1 and payment 1 carry the same mask, so matching on
  them would pair strangers.
* ``decrypt`` - equality of the decrypted ciphertext columns (``*_enc``).
  Ciphertext itself is never compared: every encryption of a value differs.
* ``token``   - equality of keyed-hash tokens (``*_tok``) written beside the
  ciphertext: a plain hash join, no per-row decryption.

The join key is computed in a projection before the join; the join itself is
a shuffle (or AQE broadcast) equi-join, and an account that pays a third of
all payments is a skewed key that AQE's skew-join handling splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.crypto import decrypt_text
from ..model import live
from .windows import materialize

MASK_PREFIX = "ENC-"


def _clear_key(c: str) -> Column:
    v = F.rtrim(F.col(c))
    return F.when(~v.startswith(MASK_PREFIX), v)


def account_key(df: DataFrame, column: str, mode: str, key: Column | None = None) -> Column:
    if mode == "clear":
        return _clear_key(column)
    if mode == "decrypt":
        if key is None:
            raise ValueError("decrypt mode needs a key")
        return F.rtrim(decrypt_text(F.col(column + "_enc"), key))
    if mode == "token":
        return F.col(column + "_tok")
    raise ValueError(f"unknown mode {mode!r}")


def match_payments_by_account(payments: DataFrame, persons: DataFrame,
                              mode: str = "clear", key: Column | None = None, prune: bool = False,
                              watch: Observation | None = None) -> DataFrame:
    """Payments joined to the live person holding the paying account.

    Returns the payment columns plus ``persona_id``.  A NULL account (or one
    that cannot be decrypted) matches nothing.

    In decrypt mode ``prune`` first keeps, by a semi-join on the tokens beside
    the ciphertext, the payments whose account a live person may hold, so only
    those are decrypted; the match itself is still that of the decrypted texts.
    ``watch`` then counts the payments that are decrypted (``descifradas``).
    """
    if prune:
        held = live(persons).select(F.col("cbu_cvu_tok").alias("cbu_cvu_origen_tok")).where(F.col("cbu_cvu_origen_tok").isNotNull())
        payments = payments.join(held, "cbu_cvu_origen_tok", "left_semi").select(*payments.columns)
    if watch is not None:
        payments = payments.observe(watch, F.count(F.lit(1)).alias("descifradas"))
    pk = account_key(payments, "cbu_cvu_origen", mode, key)
    p = payments.withColumn("acct__k", pk).filter(F.col("acct__k").isNotNull())
    per = live(persons).select("persona_id", account_key(persons, "cbu_cvu", mode, key)
                               .alias("acct__k")).filter(F.col("acct__k").isNotNull())
    return p.join(per, "acct__k").drop("acct__k")


def valid_on(date_col: Column) -> Column:
    """Closed validity interval, open end when ``fecha_hasta`` is NULL."""
    return (F.col("fecha_desde") <= date_col) & (
        F.col("fecha_hasta").isNull() | (F.col("fecha_hasta") >= date_col))


#: Days of the calendar that a hot key is split over: 2 ** LEVELS, from before
#: 1970 on; dates beyond count as its ends, and the residual decides on them.
LEVELS = 21


def _day(c: Column) -> Column:
    """Day number in the calendar, 0 to 2 ** LEVELS - 1."""
    day = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")) + (1 << (LEVELS - 1))
    return F.greatest(F.least(day, F.lit((1 << LEVELS) - 1)), F.lit(0)).cast("bigint")


def _spans(lo: Column, hi: Column) -> Column:
    """The fewest aligned spans (level, place) of 2 ** level days that make up
    the days ``lo`` to ``hi``: at most two of a level."""
    found = []
    for level in range(LEVELS + 1):
        first = F.shiftright(lo + ((1 << level) - 1), level)
        end = F.shiftright(hi + 1, level)
        for at, odd in ((first, first), (end - 1, end)):
            found.append(F.when((first < end) & (odd % 2 == 1), F.struct(F.lit(level).alias("level"), at.alias("place"))))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def tenure_as_of(events: DataFrame, tenures: DataFrame, key: str, date_col: str,
                 role: str | None = None, keep: tuple[str, ...] = ("persona_id", "uf_id"),
                 hot: int | None = None) -> DataFrame:
    """Each event with every tenure valid on its date (equi key + range).

    ``key`` is ``persona_id`` or ``uf_id``; the range condition is a residual
    of the equi-join (hash or sort-merge, never a nested loop).  Overlapping
    tenures yield one row each, as in the reports.

    With ``hot``, keys that have more than so many tenures are split by time:
    such a tenure is cut into aligned spans of days, an event belongs to one
    span of each level, and they meet on (key, level, place), each pair once.
    So events and tenures that don't meet in time are never compared, and one
    key's work is spread.  The rows are the same either way.
    """
    t = tenures
    if role is not None:
        t = t.filter(F.col("tipo_titularidad") == role)
    cols = [c for c in keep if c != key and c not in events.columns]
    t = t.select(F.col(key).alias("k__t"), *cols, "fecha_desde", "fecha_hasta")
    if hot is None:
        j = events.join(t, (events[key] == t["k__t"]) & valid_on(events[date_col]))
        return j.drop("k__t", "fecha_desde", "fecha_hasta")
    # at most one key in `hot` tenures
    crowded = materialize(t.groupBy("k__t").count().where(F.col("count") > hot).select("k__t"))
    few = t.join(crowded, "k__t", "left_anti")
    plain = events.join(few, (events[key] == few["k__t"]) & valid_on(events[date_col])).drop("k__t", "fecha_desde", "fecha_hasta")
    last = F.coalesce(_day(F.col("fecha_hasta")), F.lit((1 << LEVELS) - 1).cast("bigint"))
    spans = t.join(crowded, "k__t", "left_semi").select("*", F.explode(_spans(_day(F.col("fecha_desde")), last)).alias("s__t"))
    places = F.array(*[F.struct(F.lit(level).alias("level"), F.shiftright(_day(F.col(date_col)), level).alias("place"))
                       for level in range(LEVELS + 1)])
    met = (events.join(crowded.withColumnRenamed("k__t", key), key, "left_semi").select(*events.columns, F.explode(places).alias("s__e")))
    # sizes are estimated without the rows that explode adds: only a shuffle is safe
    split = met.join(spans.hint("merge"), (met[key] == spans["k__t"]) & (F.col("s__e") == F.col("s__t")) & valid_on(F.col(date_col)))
    return plain.unionByName(split.select(*plain.columns))
