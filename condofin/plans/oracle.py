"""Independent SQL (DuckDB dialect) for every registered query.

Each statement starts from the driver tables through ``DOMAIN_CTES``, the SQL
twin of :mod:`condofin.sources.driver_tables`, and states the result from the
written semantics of the reports in a form of its own (events in one stream,
owner-days, payments by ordinal).  The fan-out product itself is checked
against loops over the charges in the tests.

Numeric conventions shared with the Spark side (so both engines hash alike):
money is summed as exact DECIMAL; payment shares are differences of exact
quotients rounded to six places, so they add up; pro-rata quotients are exact to
eight places; outputs are ``CAST(ROUND(exact_sum, 2) AS DOUBLE)``; means are one
DOUBLE division of exact sums.
"""

from __future__ import annotations

DOMAIN_CTES = """
consorcio AS (
  SELECT CAST(n_nationkey AS INTEGER) AS consorcio_id, n_name AS nombre,
         'Calle ' || CAST(n_nationkey AS VARCHAR) AS direccion,
         CAST(NULL AS INTEGER) AS cant_unidades,
         CAST((n_nationkey + 1) * 1000 AS DECIMAL(10,2)) AS cant_m2_total,
         FALSE AS borrado
  FROM nation),
unidad AS (
  SELECT c_custkey AS uf_id, CAST(c_nationkey AS INTEGER) AS consorcio_id,
         CASE WHEN c_custkey % 10 = 0 THEN 'PB'
              ELSE lpad(CAST(c_custkey % 10 AS VARCHAR), 2, '0') END AS piso,
         chr(CAST(65 + c_custkey % 5 AS INTEGER)) AS depto,
         CAST(40 + c_custkey % 31 AS DECIMAL(10,2)) AS cant_m2,
         CAST(1 + c_custkey % 7 AS DECIMAL(9,4)) AS coeficiente,
         (c_custkey % 50 = 0) AS borrado
  FROM customer),
accesoria AS (
  SELECT c_custkey AS uf_id, CAST(4 AS DECIMAL(10,2)) AS m2_accesorio, 'BAULERA' AS tipo_accesorio
  FROM customer WHERE c_custkey % 4 = 0
  UNION ALL
  SELECT c_custkey, CAST(12 AS DECIMAL(10,2)), 'COCHERA' FROM customer WHERE c_custkey % 6 = 0),
persona AS (
  SELECT c_custkey AS persona_id, c_name AS nombre,
         'Apellido' || lpad(CAST(c_custkey % 97 AS VARCHAR), 3, '0') AS apellido,
         CAST(20000000 + c_custkey AS BIGINT) AS dni,
         'persona' || CAST(c_custkey AS VARCHAR) || '@correo.test' AS email,
         CAST(1100000000 + c_custkey AS BIGINT) AS telefono,
         lpad(CAST(c_custkey AS VARCHAR), 22, '0') AS cbu_cvu,
         (c_custkey % 43 = 42) AS borrado
  FROM customer),
titularidad AS (
  SELECT c_custkey AS persona_id, c_custkey AS uf_id, DATE '1990-01-01' AS fecha_desde,
         DATE '1998-06-30' AS fecha_hasta, 'PROPIETARIO' AS tipo_titularidad FROM customer
  UNION ALL
  SELECT c_custkey, xor(c_custkey, 1), DATE '1998-07-01', CAST(NULL AS DATE), 'PROPIETARIO' FROM customer
  UNION ALL
  SELECT c_custkey, xor(c_custkey, 2), DATE '1995-01-01', CAST(NULL AS DATE), 'INQUILINO'
  FROM customer WHERE c_custkey % 3 = 0
  UNION ALL
  SELECT c_custkey, xor(c_custkey, 1), DATE '2000-01-01', CAST(NULL AS DATE), 'PROPIETARIO'
  FROM customer WHERE c_custkey % 11 = 0),
expensa AS (
  SELECT o_orderkey AS expensa_id, CAST(c_nationkey AS INTEGER) AS consorcio_id,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS periodo,
         (o_orderkey % 59 = 58) AS borrado
  FROM orders JOIN customer ON c_custkey = o_custkey),
pago AS (
  SELECT o_orderkey AS pago_id, o_orderkey AS expensa_id, o_orderdate AS fecha,
         CAST(o_totalprice AS DECIMAL(18,2)) AS importe,
         CASE o_orderstatus WHEN 'F' THEN 'APLICADO' WHEN 'O' THEN 'ASOCIADO' ELSE 'PENDIENTE' END AS estado,
         CASE WHEN o_orderkey % 97 = 96 THEN NULL ELSE lpad(CAST(o_custkey AS VARCHAR), 22, '0') END AS cbu_cvu_origen,
         (o_orderkey % 71 = 70) AS borrado
  FROM orders),
charges AS (
  SELECT l_orderkey AS expensa_id,
         CASE l_returnflag WHEN 'N' THEN 'ordinario' WHEN 'R' THEN 'extraordinario'
                           WHEN 'A' THEN 'mora' END AS concepto,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS importe,
         l_orderkey * 8 + l_linenumber AS mora_id,
         CAST(l_shipdate AS DATE) AS fecha_aplicacion,
         (l_linenumber = 7) AS borrado
  FROM lineitem),
ordinarios AS (SELECT expensa_id, importe, borrado FROM charges WHERE concepto = 'ordinario'),
extraordinarios AS (SELECT expensa_id, importe AS valor_cuota_actual, borrado FROM charges WHERE concepto = 'extraordinario'),
mora AS (SELECT mora_id, expensa_id, fecha_aplicacion, importe, borrado FROM charges WHERE concepto = 'mora')
"""


def with_domain(body: str) -> str:
    """Prefix a statement whose own CTEs follow the domain ones."""
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + DOMAIN_CTES.strip() + ",\n" + body[5:]
    return "WITH " + DOMAIN_CTES.strip() + "\n" + body


def _money(expr: str) -> str:
    return f"CAST(ROUND({expr}, 2) AS DOUBLE)"


def _share(amount: str, part: str, base: str) -> str:
    """amount * part / base (not negative, two decimals each) in whole units of
    10^-6, halves up."""
    a, p, q = (f"CAST({x} * {by} AS HUGEINT)" for x, by in ((amount, 1000000), (f"({part})", 100), (base, 100)))
    return f"CAST((2 * {a} * {p} + {q}) // (2 * {q}) AS DECIMAL(32,0)) * 0.000001"


def prorated(weighted: str, total: str) -> str:
    """weighted (six decimals) over total (four decimals) in whole units of
    10^-8, halves up, as DOUBLE; 0 if the total is not positive."""
    n, q = f"CAST({weighted} * 1000000 AS HUGEINT)", f"CAST({total} * 10000 AS HUGEINT)"
    return (f"CASE WHEN {total} > 0 THEN CAST(CAST((2000000 * {n} + {q}) // (2 * {q}) AS DECIMAL(32,0)) * 0.000001 AS DOUBLE) / 100 "
            "ELSE 0.0 END")


def _range(col: str, d_from: str, d_to: str) -> str:
    return f"{col} >= DATE '{d_from}' AND {col} < DATE '{d_to}' + INTERVAL 1 DAY"


def _bfilter(col: str, building) -> str:
    return "" if building is None else f" AND {col} = {int(building)}"


def totals_sql(concepts: int, fanout: str = "reference") -> str:
    """CTEs ``cobros`` (one pass over the live charges: sum and number of each
    kind per bill) and ``totales`` (every live bill with its building, the total
    of each concept and their sum ``base``).

    With the reference fan-out a kind's total is repeated once for each charge
    of every other kind, which is a product of numbers of charges.
    """
    kinds = ("ordinario", "extraordinario", "mora")[:concepts]
    sums = ", ".join(f"SUM(importe) FILTER (concepto = '{k}') AS s{i}, "
                     f"COUNT(*) FILTER (concepto = '{k}') AS n{i}" for i, k in enumerate(kinds))
    totals = []
    for i in range(concepts):
        times = "".join(f" * CAST(GREATEST(COALESCE(n{j}, 0), 1) AS DECIMAL(6,0))"
                        for j in range(concepts) if j != i and fanout == "reference")
        totals.append(f"CAST(COALESCE(s{i}, 0) AS DECIMAL(24,2)){times} AS {TOTALS[i]}")
    return f"""cobros AS (SELECT expensa_id, {sums} FROM charges WHERE NOT borrado GROUP BY expensa_id),
totales AS (
  SELECT *, {' + '.join(TOTALS[:concepts])} AS base
  FROM (SELECT expensa_id, consorcio_id, periodo, {', '.join(totals)}
        FROM expensa LEFT JOIN cobros USING (expensa_id) WHERE NOT borrado))"""


TOTALS = ["total_ordinario", "total_extra", "total_mora"]


VALID_PAYMENT = "NOT pago.borrado AND pago.estado <> 'PENDIENTE'"


def classified_payments_sql(concepts: int, d_from: str, d_to: str, building=None,
                            fanout: str = "reference") -> str:
    """CTEs of :func:`totals_sql` and ``clasificados``: the valid payments of
    the range, each shared over its bill's concepts; a bill without a positive
    base takes all of it as ordinary."""
    shares, before = [], "0"
    for i, n in enumerate(TOTALS[:concepts]):
        nothing = "importe" if i == 0 else "0"
        upto = _share("importe", " + ".join(TOTALS[:i + 1]), "base")
        shares.append(f"CASE WHEN base > 0 THEN CAST({upto} - {before} AS DECIMAL(38,6)) "
                      f"ELSE CAST({nothing} AS DECIMAL(38,6)) END AS share_{n.split('_')[1]}")
        before = upto
    return f"""{totals_sql(concepts, fanout)},
clasificados AS (
  SELECT pago_id, consorcio_id, fecha, importe AS importe_total,
         {(',' + chr(10) + '         ').join(shares)}
  FROM totales JOIN pago USING (expensa_id)
  WHERE {VALID_PAYMENT} AND {_range('fecha', d_from, d_to)}{_bfilter('consorcio_id', building)})"""
