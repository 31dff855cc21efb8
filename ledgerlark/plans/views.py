"""Stand-in tables for the analytic domains, derived from the test tables.

Each view exists twice: as a DataFrame and as a common table expression for the SQL checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlark.functions.scalars import as_doubles


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- transactions -------------------------------------------------------------------------------

TX = """tx AS (
  SELECT md5(concat_ws(':', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE))) AS id,
         l_orderkey AS k, CAST(l_shipdate AS DATE) AS fecha, p_name AS descripcion,
         CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE -l_extendedprice END AS valor
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    amount = F.col("l_extendedprice")
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.to_date("l_shipdate")]
    return lines.join(part, lines.l_partkey == part.p_partkey).select(
        F.md5(F.concat_ws(":", *keys)).alias("id"),
        F.col("l_orderkey").alias("k"),
        F.to_date("l_shipdate").alias("fecha"),
        F.col("p_name").alias("descripcion"),
        F.when(F.col("l_returnflag") == "R", amount).otherwise(-amount).alias("valor"),
    )


TX_RAW = TX + """, tx_raw AS (
  SELECT id, k,
         CASE WHEN k % 17 = 0 THEN NULL
              WHEN k % 23 = 0 THEN 'sin fecha'
              WHEN k % 10 = 3 THEN concat(day(fecha), '/', month(fecha))
              ELSE concat(day(fecha), '/', month(fecha), '/', year(fecha)) END AS "FECHA",
         concat(' ', upper(descripcion), '  ') AS " Descripcion ",
         CASE WHEN k % 19 = 0 THEN NULL
              WHEN k % 29 = 0 THEN 'nan'
              WHEN k % 31 = 0 THEN 'abc'
              ELSE concat('$ ', format('{:,.2f}', valor)) END AS "VALOR",
         CAST(NULL AS VARCHAR) AS "Unnamed: 3"
  FROM tx)"""


def tx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as text: mixed dates, money with signs and commas, a blank column."""
    k, day = F.col("k"), F.col("fecha")
    return tx(spark, sf_dir).select(
        "id",
        "k",
        F.when(k % 17 == 0, None)
        .when(k % 23 == 0, "sin fecha")
        .when(k % 10 == 3, F.date_format(day, "d/M"))
        .otherwise(F.date_format(day, "d/M/yyyy"))
        .alias("FECHA"),
        F.concat(F.lit(" "), F.upper("descripcion"), F.lit("  ")).alias(" Descripcion "),
        F.when(k % 19 == 0, None)
        .when(k % 29 == 0, "nan")
        .when(k % 31 == 0, "abc")
        .otherwise(F.concat(F.lit("$ "), F.format_number("valor", 2)))
        .alias("VALOR"),
        F.lit(None).cast("string").alias("Unnamed: 3"),
    )


# --- panel: nation by order year ----------------------------------------------------------------

PANEL_FEATURES = [
    "liquidez",
    "dias_efectivo",
    "cfo",
    "participacion_ley30",
    "participacion_regalias",
    "participacion_servicios",
    "participacion_matriculas",
    "hhi_fuentes",
    "endeudamiento",
    "tendencia_ingresos",
    "gp_ratio",
]

PANEL = """cells AS (
  SELECT n_name AS unidad, CAST(year(o_orderdate) AS INTEGER) AS anio, c_nationkey AS nk,
         count(*) AS n, round(sum(o_totalprice), 2) AS ingresos,
         round(sum(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice ELSE 0 END), 2) AS gastos,
         round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS cerrado,
         round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END), 2) AS abierto,
         round(sum(c_acctbal), 2) AS saldo,
         round(sum(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN o_totalprice ELSE 0 END), 2) AS s1,
         round(sum(CASE WHEN c_mktsegment = 'BUILDING' THEN o_totalprice ELSE 0 END), 2) AS s2,
         round(sum(CASE WHEN c_mktsegment = 'FURNITURE' THEN o_totalprice ELSE 0 END), 2) AS s3
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY n_name, year(o_orderdate), c_nationkey),
panel AS (
  SELECT a.unidad, a.anio, a.ingresos AS ingresos_totales, a.gastos AS gastos_personal,
         CASE WHEN (a.nk * 7 + a.anio) % 40 <> 0 THEN round(a.cerrado / (a.abierto + 1), 6) END AS liquidez,
         CASE WHEN (a.nk * 5 + a.anio) % 80 <> 0 THEN round(60.0 * a.gastos / (a.abierto + 1), 6) END AS dias_efectivo,
         CASE WHEN (a.nk * 3 + a.anio) % 16 <> 0 THEN round(a.cerrado - a.abierto, 2) END AS cfo,
         CASE WHEN (a.nk + a.anio) % 20 <> 0 THEN round(a.s1 / a.ingresos, 6) END AS participacion_ley30,
         round(a.s2 / a.ingresos, 6) AS participacion_regalias,
         round(a.s3 / a.ingresos, 6) AS participacion_servicios,
         round((a.ingresos - a.s1 - a.s2 - a.s3) / a.ingresos, 6) AS participacion_matriculas,
         CASE WHEN (a.nk * 11 + a.anio) % 80 <> 0 THEN round((a.s1 * a.s1 + a.s2 * a.s2 + a.s3 * a.s3) / (a.ingresos * a.ingresos), 6) END AS hhi_fuentes,
         CASE WHEN (a.nk * 2 + a.anio) % 10 <> 0 THEN round(a.saldo / a.n, 4) END AS endeudamiento,
         round(a.ingresos / b.ingresos - 1, 6) AS tendencia_ingresos,
         round(a.gastos / a.ingresos, 6) AS gp_ratio,
         CAST(CASE WHEN (a.n + a.nk) % 6 = 0 THEN a.n % 2 WHEN a.cerrado < a.abierto THEN 1 ELSE 0 END AS INTEGER) AS label
  FROM cells a LEFT JOIN cells b ON a.unidad = b.unidad AND a.anio = b.anio + 1)"""


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per nation and year, with gaps; rounded so that both engines see equal inputs."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    price = F.col("o_totalprice")

    def total(condition, amount=price):
        return F.round(F.sum(F.when(condition, amount).otherwise(0.0)), 2)

    segment, status = F.col("c_mktsegment"), F.col("o_orderstatus")
    cells = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", F.year("o_orderdate").alias("anio"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.round(F.sum(price), 2).alias("ingresos"),
            total(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("gastos"),
            total(status == "F").alias("cerrado"),
            total(status == "O").alias("abierto"),
            F.round(F.sum("c_acctbal"), 2).alias("saldo"),
            total(segment == "AUTOMOBILE").alias("s1"),
            total(segment == "BUILDING").alias("s2"),
            total(segment == "FURNITURE").alias("s3"),
        )
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumnRenamed("n_name", "unidad")
        .withColumnRenamed("c_nationkey", "nk")
    )
    before = cells.select(
        "unidad", (F.col("anio") + 1).alias("anio"), F.col("ingresos").alias("previo")
    )
    a = cells.join(before, ["unidad", "anio"], "left")
    nk, year, n = F.col("nk"), F.col("anio"), F.col("n")
    income, costs = F.col("ingresos"), F.col("gastos")
    closed, still_open = F.col("cerrado"), F.col("abierto")
    s1, s2, s3 = F.col("s1"), F.col("s2"), F.col("s3")

    def gap(factor, modulus, value):
        return F.when((nk * factor + year) % modulus != 0, value)

    return a.select(
        "unidad",
        "anio",
        income.alias("ingresos_totales"),
        costs.alias("gastos_personal"),
        gap(7, 40, F.round(closed / (still_open + 1), 6)).alias("liquidez"),
        gap(5, 80, F.round(60.0 * costs / (still_open + 1), 6)).alias("dias_efectivo"),
        gap(3, 16, F.round(closed - still_open, 2)).alias("cfo"),
        gap(1, 20, F.round(s1 / income, 6)).alias("participacion_ley30"),
        F.round(s2 / income, 6).alias("participacion_regalias"),
        F.round(s3 / income, 6).alias("participacion_servicios"),
        F.round((income - s1 - s2 - s3) / income, 6).alias("participacion_matriculas"),
        gap(11, 80, F.round((s1 * s1 + s2 * s2 + s3 * s3) / (income * income), 6)).alias(
            "hhi_fuentes"
        ),
        gap(2, 10, F.round(F.col("saldo") / n, 4)).alias("endeudamiento"),
        F.round(income / F.col("previo") - 1, 6).alias("tendencia_ingresos"),
        F.round(costs / income, 6).alias("gp_ratio"),
        F.when((n + nk) % 6 == 0, n % 2)
        .when(closed < still_open, 1)
        .otherwise(0)
        .cast("int")
        .alias("label"),
    )


# --- passengers: orders with their customers ----------------------------------------------------

PASSENGERS = """passengers AS (
  SELECT o_orderkey AS id, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS INTEGER) AS survived,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS pclass,
         CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE c_mktsegment END AS sex,
         CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE c_acctbal END AS age,
         CAST(o_custkey % 5 AS INTEGER) AS sibsp, CAST(o_orderkey % 4 AS INTEGER) AS parch,
         CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE round(o_totalprice, 2) END AS fare,
         CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN c_nationkey % 3 = 0 THEN 'S'
              WHEN c_nationkey % 3 = 1 THEN 'C' ELSE 'Q' END AS embarked,
         CASE WHEN o_orderkey % 4 < 3 THEN NULL ELSE concat('C', c_nationkey) END AS cabin
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    key, nation = F.col("o_orderkey"), F.col("c_nationkey")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        key.alias("id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("survived"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("pclass"),
        F.when(key % 37 != 0, F.col("c_mktsegment")).alias("sex"),
        F.when(key % 9 != 0, F.col("c_acctbal")).alias("age"),
        (F.col("o_custkey") % 5).cast("int").alias("sibsp"),
        (key % 4).cast("int").alias("parch"),
        F.when(key % 41 != 0, F.round("o_totalprice", 2)).alias("fare"),
        F.when(key % 50 == 0, None)
        .when(nation % 3 == 0, "S")
        .when(nation % 3 == 1, "C")
        .otherwise("Q")
        .alias("embarked"),
        F.when(key % 4 >= 3, F.concat(F.lit("C"), nation.cast("string"))).alias("cabin"),
    )


SCORED = PASSENGERS + """, scored AS (
  SELECT id, survived AS y, round((fare % 997) / 997 * 0.8 + survived * 0.15, 2) AS score
  FROM passengers WHERE fare IS NOT NULL),
judged AS (SELECT *, CAST(CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS INTEGER) AS pred FROM scored)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passengers with a deterministic score that carries some signal, and its 0/1 decision."""
    base = passengers(spark, sf_dir).where(F.col("fare").isNotNull())
    score = F.round(F.col("fare") % 997 / 997 * 0.8 + F.col("survived") * 0.15, 2)
    return base.select("id", F.col("survived").alias("y"), score.alias("score")).withColumn(
        "pred", (F.col("score") >= 0.5).cast("int")
    )


# --- movie records: events as JSON text ---------------------------------------------------------

RECORDS = """fields AS (
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, user_id FROM events),
typed AS (
  SELECT event_id, concat('t', event_id) AS title,
         CASE WHEN event_id % 17 = 0 THEN 'False' ELSE 'True' END AS response,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE (50 + k % 50) / 10.0 END AS rating,
         user_id * 1237 + event_id AS votes,
         CASE WHEN k % 11 = 0 THEN 0 ELSE 80 + k % 100 END AS runtime,
         1950 + k % 70 AS year
  FROM fields WHERE event_id % 101 <> 0)"""


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw replies as JSON lines: some cut short, some without a rating, some refused."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    key = F.col("event_id")
    start = (1950 + k % 70).cast("string")
    reply = F.struct(
        F.when(key % 17 == 0, "False").otherwise("True").alias("Response"),
        F.concat(F.lit("t"), key.cast("string")).alias("Title"),
        F.when(key % 13 == 0, "N/A")
        .otherwise(((50 + k % 50) / 10.0).cast("string"))
        .alias("imdbRating"),
        F.format_number(F.col("user_id") * 1237 + key, 0).alias("imdbVotes"),
        F.when(k % 11 == 0, "N/A")
        .otherwise(F.concat((80 + k % 100).cast("string"), F.lit(" min")))
        .alias("Runtime"),
        F.when(key % 7 == 0, F.concat(start, F.lit("–2024"))).otherwise(start).alias("Year"),
    )
    text = F.to_json(reply)
    return e.select(
        key, F.when(key % 101 == 0, F.substring(text, 1, 20)).otherwise(text).alias("raw")
    )


# --- vectors ------------------------------------------------------------------------------------

VECTORS = """vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label,
         CAST(label % 2 AS INTEGER) AS y FROM embeddings),
points AS (SELECT vec_id, label, y, v, v[1] AS x0, v[2] AS x1 FROM vectors)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id",
        as_doubles(F.col("embedding")).alias("v"),
        "label",
        (F.col("label") % 2).cast("int").alias("y"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole vectors with their first two entries beside them, for rules that read single columns."""
    base = vectors(spark, sf_dir)
    return base.select("vec_id", "label", "y", "v", F.col("v")[0].alias("x0"), F.col("v")[1].alias("x1"))


def with_sql(view: str, body: str) -> str:
    return f"WITH RECURSIVE {view} {body}"
