"""Map the TPC-H-style driver tables onto the domain tables.

The reference ships no table contents, so the test data of this repository
are the generated ``nation / customer / orders / lineitem`` parquet files.
The rules below are ours (documented in README.md) and are mirrored, one to
one, by ``condofin.plans.oracle.DOMAIN_CTES`` for the DuckDB oracle.

* building  <- nation     (id = n_nationkey, name = n_name)
* unit      <- customer   (id = c_custkey, building = c_nationkey)
* person    <- customer   (id = c_custkey, account = c_custkey padded to 22)
* tenure    <- customer   (own unit until mid-1998, neighbour unit after,
                           a tenant row every third key, an overlapping
                           duplicate owner row every eleventh key)
* bill      <- orders     (id = o_orderkey, building = customer's nation)
* payment   <- orders     (one per bill, state from o_orderstatus)
* charges   <- lineitem   (N ordinary, R extraordinary, A late interest)

Every rule is a per-row projection except the bill's building, a join of
orders with customer on the customer key (AQE broadcasts customer only when
its measured size is under the threshold).  Each mapped table reads only the
columns it needs, so Parquet column pruning and filter pushdown still apply.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import (AREA, COEF, EXTRAORDINARIO, MONEY, MORA, ORDINARIO,
                     OWNER_ROLE, TENANT_ROLE, Tables)

# Tenure boundaries of the mapping.
FIRST_TENURE_FROM = dt.date(1990, 1, 1)
FIRST_TENURE_TO = dt.date(1998, 6, 30)
SECOND_TENURE_FROM = dt.date(1998, 7, 1)
TENANT_FROM = dt.date(1995, 1, 1)
OVERLAP_FROM = dt.date(2000, 1, 1)


# Schemas of the driver tables.  Declaring them spares the
# schema-inference job Spark otherwise runs for every read.
DRIVER_SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
}


def read_driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = DRIVER_SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def _pad22(c):
    return F.lpad(c.cast("string"), 22, "0")


def consorcio(nation: DataFrame) -> DataFrame:
    return nation.select(
        F.col("n_nationkey").cast("int").alias("consorcio_id"),
        F.col("n_name").alias("nombre"),
        F.concat(F.lit("Calle "), F.col("n_nationkey").cast("string")).alias("direccion"),
        F.lit(None).cast("int").alias("cant_unidades"),
        ((F.col("n_nationkey") + 1) * 1000).cast(AREA).alias("cant_m2_total"),
        F.lit(False).alias("borrado"),
    )


def unidad(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.alias("uf_id"),
        F.col("c_nationkey").cast("int").alias("consorcio_id"),
        F.when(k % 10 == 0, F.lit("PB"))
         .otherwise(F.lpad((k % 10).cast("string"), 2, "0")).alias("piso"),
        F.expr("chr(65 + c_custkey % 5)").alias("depto"),
        (F.lit(40) + k % 31).cast(AREA).alias("cant_m2"),
        (F.lit(1) + k % 7).cast(COEF).alias("coeficiente"),
        (k % 50 == 0).alias("borrado"),
    )


def accesoria(customer: DataFrame) -> DataFrame:
    """Storage rooms and parking spaces from one scan of customer."""
    k = F.col("c_custkey")

    def acc(applies, m2, kind):
        return F.when(applies, F.struct(F.lit(m2).cast(AREA).alias("m2_accesorio"),
                                        F.lit(kind).alias("tipo_accesorio")))

    a = customer.select(k.alias("uf_id"), F.explode(F.array(
        acc(k % 4 == 0, 4, "BAULERA"), acc(k % 6 == 0, 12, "COCHERA"))).alias("a"))
    return a.filter(F.col("a").isNotNull()).select("uf_id", "a.m2_accesorio", "a.tipo_accesorio")


def persona(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.alias("persona_id"),
        F.col("c_name").alias("nombre"),
        F.concat(F.lit("Apellido"), F.lpad((k % 97).cast("string"), 3, "0")).alias("apellido"),
        (F.lit(20000000) + k).cast("bigint").alias("dni"),
        F.concat(F.lit("persona"), k.cast("string"), F.lit("@correo.test")).alias("email"),
        (F.lit(1100000000) + k).cast("bigint").alias("telefono"),
        _pad22(k).alias("cbu_cvu"),
        (k % 43 == 42).alias("borrado"),
    )


def titularidad(customer: DataFrame) -> DataFrame:
    """Four tenure rules from one scan of customer: an array of candidate
    rows per key (NULL where a rule does not apply), exploded and filtered."""
    k = F.col("c_custkey")

    def row(unit, start, end, role, applies=F.lit(True)):
        return F.when(applies, F.struct(
            unit.alias("uf_id"), F.lit(start).alias("fecha_desde"),
            F.lit(end).cast("date").alias("fecha_hasta"), F.lit(role).alias("tipo_titularidad")))

    rules = F.array(
        row(k, FIRST_TENURE_FROM, FIRST_TENURE_TO, OWNER_ROLE),
        row(k.bitwiseXOR(1), SECOND_TENURE_FROM, None, OWNER_ROLE),
        row(k.bitwiseXOR(2), TENANT_FROM, None, TENANT_ROLE, k % 3 == 0),
        row(k.bitwiseXOR(1), OVERLAP_FROM, None, OWNER_ROLE, k % 11 == 0))
    t = customer.select(k.alias("persona_id"), F.explode(rules).alias("t")).filter(F.col("t").isNotNull())
    return t.select("persona_id", "t.uf_id", "t.fecha_desde", "t.fecha_hasta", "t.tipo_titularidad")


def expensa(orders: DataFrame, customer: DataFrame) -> DataFrame:
    o = orders.select("o_orderkey", "o_custkey", "o_orderdate")
    c = customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return o.join(c, "o_custkey").select(
        F.col("o_orderkey").alias("expensa_id"),
        F.col("c_nationkey").cast("int").alias("consorcio_id"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("periodo"),
        (F.col("o_orderkey") % 59 == 58).alias("borrado"),
    )


def pago(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return orders.select(
        k.alias("pago_id"),
        k.alias("expensa_id"),
        F.col("o_orderdate").alias("fecha"),
        F.col("o_totalprice").cast(MONEY).alias("importe"),
        F.when(F.col("o_orderstatus") == "F", "APLICADO")
         .when(F.col("o_orderstatus") == "O", "ASOCIADO")
         .otherwise("PENDIENTE").alias("estado"),
        F.when(k % 97 == 96, F.lit(None).cast("string"))
         .otherwise(_pad22(F.col("o_custkey"))).alias("cbu_cvu_origen"),
        (k % 71 == 70).alias("borrado"),
    )


def charges(lineitem: DataFrame) -> DataFrame:
    flag = F.col("l_returnflag")
    return lineitem.select(
        F.col("l_orderkey").alias("expensa_id"),
        F.when(flag == "N", ORDINARIO).when(flag == "R", EXTRAORDINARIO)
         .when(flag == "A", MORA).alias("concepto"),
        F.col("l_extendedprice").cast(MONEY).alias("importe"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("mora_id"),
        F.col("l_shipdate").cast("date").alias("fecha_aplicacion"),
        (F.col("l_linenumber") == 7).alias("borrado"),
    )


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """All domain tables of one driver scale-factor directory (lazy)."""
    nation = read_driver(spark, sf_dir, "nation")
    customer = read_driver(spark, sf_dir, "customer")
    orders = read_driver(spark, sf_dir, "orders")
    lineitem = read_driver(spark, sf_dir, "lineitem")
    return Tables(
        consorcio=consorcio(nation),
        unidad=unidad(customer),
        accesoria=accesoria(customer),
        persona=persona(customer),
        titularidad=titularidad(customer),
        expensa=expensa(orders, customer),
        charges=charges(lineitem),
        pago=pago(orders),
    )
