"""Queries on the transaction view: cleaning, labels, features and their chart data."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ledgerlark import presets
from ledgerlark.functions.calendar import calendar_parts
from ledgerlark.functions.parse import (
    clean_text,
    contains_any,
    parse_day_first,
    parse_money,
    strip_punctuation,
    with_date_ladder,
)
from ledgerlark.functions.scalars import flag_at_least
from ledgerlark.operators import charts, features, prep, profile, rules, text
from ledgerlark.operators.quantiles import exact_quantiles
from ledgerlark.plans import flows
from ledgerlark.plans.registry import query
from ledgerlark.plans.views import TX, TX_RAW, table, tx, tx_raw, with_sql
from ledgerlark.sources import tables

EXCLUDED = ["ring", "gizmo"]
THRESHOLD = 25_000.0
ALWAYS = ["NEW BOLT", "OLD"]
NEVER = [["RING", "ROD"], ["GIZMO"], ["HOT PL"]]
SMALL = """CASE WHEN contains(descripcion, 'ring') OR contains(descripcion, 'gizmo') THEN 0
           WHEN abs(valor) <= 25000 THEN 1 ELSE 0 END"""
OUT = TX + f""", gastos AS (
  SELECT *, CAST({SMALL} AS INTEGER) AS es_gasto_hormiga, abs(valor) AS valor_abs
  FROM tx WHERE valor < 0)"""


def outflows(spark, sf_dir):
    """Outflows with their small-spend flag."""
    spent = rules.keep_outflows(tx(spark, sf_dir), "valor")
    label = rules.small_spend_flag(F.col("descripcion"), F.col("valor"), EXCLUDED, THRESHOLD)
    return spent.withColumn("es_gasto_hormiga", label).withColumn("valor_abs", F.abs("valor"))


def exact_mean(mean, n):
    """The mean as cents over rows, which is the same double in every engine."""
    return (F.round(F.col(mean) * F.col(n), 2) / F.col(n)).alias(mean)


@query(
    with_sql(
        OUT,
        """SELECT fecha, es_gasto_hormiga, round(sum(valor_abs), 2) AS total, count(*) AS n,
        round(sum(valor_abs) / sum(sum(valor_abs)) OVER (PARTITION BY fecha), 6) AS share
        FROM gastos GROUP BY fecha, es_gasto_hormiga""",
    )
)
def flagship_daily_small_spend(spark, sf_dir):
    daily = charts.daily_series(outflows(spark, sf_dir), "fecha", "es_gasto_hormiga", "valor_abs")
    day_total = F.sum("_total").over(W.partitionBy("fecha"))
    return daily.select(
        "fecha",
        "es_gasto_hormiga",
        F.round("_total", 2).alias("total"),
        "n",
        F.round(F.col("_total") / day_total, 6).alias("share"),
    )


RAW_CLEAN = """SELECT id,
  CASE WHEN regexp_full_match("FECHA", '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}')
         THEN CAST(strptime("FECHA", '%d/%m/%Y') AS DATE)
       WHEN regexp_full_match("FECHA", '[0-9]{1,2}/[0-9]{1,2}')
         THEN CAST(try_strptime(concat("FECHA", '/1999'), '%d/%m/%Y') AS DATE) END AS fecha,
  trim(lower(" Descripcion ")) AS descripcion,
  CASE WHEN "VALOR" IN ('nan') THEN NULL
       ELSE TRY_CAST(replace(replace(replace(trim("VALOR"), '$', ''), ' ', ''), ',', '') AS DOUBLE) END AS valor
  FROM tx_raw"""


@query(with_sql(TX_RAW, RAW_CLEAN))
def clean_parse_money_dates(spark, sf_dir):
    raw = tables.normalise_headers(tables.drop_blank_columns(tx_raw(spark, sf_dir)))
    return raw.select(
        "id",
        parse_day_first(F.col("fecha"), default_year=1999).alias("fecha"),
        clean_text(F.col("descripcion")).alias("descripcion"),
        parse_money(F.col("valor")).alias("valor"),
    )


@query(with_sql(TX_RAW, RAW_CLEAN))
def csv_roundtrip(spark, sf_dir):
    """Write the raw table as CSV to a fresh shared folder, read it back and clean it."""
    raw = tx_raw(spark, sf_dir).drop("k")
    path = tables.write_csv(raw, sep=";")
    back = tables.read_csv(spark, path, schema=raw.schema, sep=";")
    back = tables.normalise_headers(tables.drop_blank_columns(back))
    return back.select(
        "id",
        parse_day_first(F.col("fecha"), default_year=1999).alias("fecha"),
        clean_text(F.col("descripcion")).alias("descripcion"),
        parse_money(F.col("valor")).alias("valor"),
    )


@query(
    with_sql(
        TX,
        """, texts AS (SELECT id, k, fecha, strftime(fecha, '%-d/%-m/%Y') AS day_first,
             strftime(fecha, '%-m/%-d/%Y') AS month_first FROM tx)
        SELECT id, fecha AS from_day_first, fecha AS from_month_first FROM texts""",
    )
)
def date_format_ladder(spark, sf_dir):
    """Each text column is read with the first pattern that fits all of its rows."""
    texts = tx(spark, sf_dir).select(
        "id",
        F.date_format("fecha", "d/M/yyyy").alias("d"),
        F.date_format("fecha", "M/d/yyyy").alias("m"),
    )
    out = with_date_ladder(texts, "d", "from_day_first")
    return with_date_ladder(out, "m", "from_month_first").drop("d", "m")


@query(
    """SELECT c_custkey AS id, c_acctbal, CAST(CASE WHEN c_acctbal >= 5000 THEN 1 ELSE 0 END AS INTEGER) AS rich,
    abs(c_acctbal) AS abs_bal FROM customer WHERE c_acctbal < 0 OR c_acctbal >= 5000
    ORDER BY c_custkey LIMIT 200"""
)
def project_and_flag(spark, sf_dir):
    """First rows in key order, numeric columns only, with a threshold flag."""
    acct = table(spark, sf_dir, "customer")
    keep = acct.where((F.col("c_acctbal") < 0) | (F.col("c_acctbal") >= 5000))
    numeric = keep.select(*rules.numeric_columns(keep)).drop("c_nationkey")
    amount = rules.first_present(numeric, ["saldo", "c_acctbal"])
    return (
        numeric.withColumnRenamed("c_custkey", "id")
        .withColumn("rich", flag_at_least(F.col(amount), 5000))
        .withColumn("abs_bal", F.abs(amount))
        .orderBy("id")
        .limit(200)
    )


@query(
    with_sql(
        TX,
        """SELECT descripcion, CAST(regexp_matches(descripcion, 'ring|rod|hot') AS BOOLEAN) AS hit, count(*) AS n
        FROM tx GROUP BY ALL""",
    )
)
def keyword_match(spark, sf_dir):
    hit = contains_any(F.col("descripcion"), ["ring", "rod", "hot"])
    return (
        tx(spark, sf_dir)
        .groupBy("descripcion", hit.alias("hit"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(with_sql(OUT, "SELECT id, es_gasto_hormiga FROM gastos"))
def label_threshold_rules(spark, sf_dir):
    return outflows(spark, sf_dir).select("id", "es_gasto_hormiga")


@query(
    with_sql(
        TX,
        """SELECT id, CASE WHEN contains(upper(descripcion), 'NEW BOLT') OR contains(upper(descripcion), 'OLD') THEN 'HORMIGA'
        WHEN regexp_matches(upper(descripcion), 'RING|ROD|GIZMO|HOT PL') THEN 'NO_HORMIGA'
        WHEN abs(valor) < 15000 THEN 'HORMIGA' ELSE 'NO_HORMIGA' END AS etiqueta
        FROM tx WHERE valor < 0 AND descripcion NOT IN ('red gear', 'cold plate')""",
    )
)
def label_ordered_rules(spark, sf_dir):
    kept = rules.exclude_values(tx(spark, sf_dir), "descripcion", ["red gear", "cold plate"])
    spent = rules.keep_outflows(kept, "valor")
    label = rules.ordered_keyword_label(
        F.col("descripcion"), F.abs("valor"), ALWAYS, NEVER, 15_000.0
    )
    return spent.select("id", label.alias("etiqueta"))


#: A word of every preset list, and one of none.
PRESET_WORDS = [
    *presets.NOT_AN_EXPENSE, *presets.ALWAYS_SMALL, *[w for words in presets.NEVER_SMALL.values() for w in words], "TINTO",
]


def _any_sql(words) -> str:
    return " OR ".join(f"contains(upper(trim(texto)), '{w}')" for w in words)


@query(
    with_sql(
        TX,
        f""", t AS (SELECT id, valor, CASE WHEN k % 3 = 0 THEN w ELSE lower(w) || ' ' || descripcion END AS texto
          FROM (SELECT *, {PRESET_WORDS!r}[CAST(k % {len(PRESET_WORDS)} + 1 AS INTEGER)] AS w FROM tx))
        SELECT id, CASE WHEN {_any_sql(presets.ALWAYS_SMALL)} THEN 'HORMIGA'
          WHEN {_any_sql(w for words in presets.NEVER_SMALL.values() for w in words)} THEN 'NO_HORMIGA'
          WHEN abs(valor) < {presets.ORDERED_THRESHOLD} THEN 'HORMIGA' ELSE 'NO_HORMIGA' END AS etiqueta
        FROM t WHERE valor < 0 AND texto NOT IN ({", ".join(map(repr, presets.NOT_AN_EXPENSE))})""",
    )
)
def label_ordered_presets(spark, sf_dir):
    """The ordered rules with the known word lists, over descriptions that hold those words."""
    word = F.get(F.array(*[F.lit(w) for w in PRESET_WORDS]), (F.col("k") % len(PRESET_WORDS)).cast("int"))
    text = F.when(F.col("k") % 3 == 0, word).otherwise(F.concat(F.lower(word), F.lit(" "), "descripcion"))
    return flows.label_ordered(tx(spark, sf_dir).withColumn("texto", text), "texto").select("id", "etiqueta")


@query(
    with_sql(
        TX,
        """, maybe AS (SELECT id, CASE WHEN k % 17 = 0 THEN NULL ELSE descripcion END AS descripcion FROM tx)
        SELECT id, descripcion FROM maybe WHERE descripcion IS NULL OR descripcion NOT IN ('red gear', 'cold plate')""",
    )
)
def filter_exclusions(spark, sf_dir):
    some = tx(spark, sf_dir).select(
        "id", F.when(F.col("k") % 17 != 0, F.col("descripcion")).alias("descripcion")
    )
    return rules.exclude_values(some, "descripcion", ["red gear", "cold plate"])


DATED = """, dated AS (SELECT id, CASE WHEN k % 17 = 0 THEN NULL ELSE fecha END AS fecha, descripcion, valor FROM tx)"""


def dated(spark, sf_dir):
    """Transactions of which some have no date."""
    return tx(spark, sf_dir).withColumn("fecha", F.when(F.col("k") % 17 != 0, F.col("fecha")))


@query(
    with_sql(
        TX + DATED,
        """SELECT id, CAST(day(fecha) AS INTEGER) AS dia, CAST(month(fecha) AS INTEGER) AS mes,
        CAST(isodow(fecha) - 1 AS INTEGER) AS dia_semana, CAST(quarter(fecha) AS INTEGER) AS trimestre,
        CAST(week(fecha) AS INTEGER) AS semana,
        CAST(CASE WHEN isodow(fecha) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS es_fin_semana FROM dated""",
    )
)
def calendar_features(spark, sf_dir):
    parts = calendar_parts(F.col("fecha"))
    return dated(spark, sf_dir).select("id", *[c.alias(n) for n, c in parts.items()])


@query(
    with_sql(
        TX + DATED,
        """, v AS (SELECT *, abs(valor) AS valor_abs FROM dated)
        SELECT id,
          CASE WHEN fecha IS NOT NULL THEN count(*) OVER (PARTITION BY fecha) END AS freq_gastos_dia,
          CASE WHEN fecha IS NOT NULL THEN round(sum(valor_abs) OVER (PARTITION BY fecha), 2) END AS gasto_diario_acumulado,
          count(*) OVER (PARTITION BY descripcion) AS freq_por_descripcion,
          round(sum(valor_abs) OVER (PARTITION BY descripcion), 2) / count(*) OVER (PARTITION BY descripcion) AS gasto_promedio_descripcion FROM v""",
    )
)
def group_broadcast_features(spark, sf_dir):
    rows = dated(spark, sf_dir).withColumn("valor_abs", F.abs("valor"))
    out = features.add_day_totals(rows, "fecha", "valor_abs")
    out = features.add_group_profile(out, "descripcion", "valor_abs", source=rows)
    return out.select(
        "id",
        "freq_gastos_dia",
        F.round("gasto_diario_acumulado", 2).alias("gasto_diario_acumulado"),
        "freq_por_descripcion",
        exact_mean("gasto_promedio_descripcion", "freq_por_descripcion"),
    )


MATRIX = ["valor", "log_valor", "quintil", "frecuencia", "dia", "mes", "dia_semana", "trimestre", "semana", "es_fin_semana"]


@query(
    with_sql(
        TX_RAW,
        f""", r AS (SELECT id, trim(" Descripcion ") AS d, trim("FECHA") AS f,
            abs(CASE WHEN "VALOR" LIKE '$ %' THEN CAST(replace(substr("VALOR", 3), ',', '') AS DOUBLE) END) AS valor FROM tx_raw),
        g AS (SELECT id, d, valor, CAST(try_strptime(CASE WHEN regexp_full_match(f, '\\d{{1,2}}/\\d{{1,2}}') THEN f || '/2024' ELSE f END,
            '%d/%m/%Y') AS DATE) AS f FROM r WHERE valor IS NOT NULL),
        edges AS (SELECT list_sort(list_distinct(quantile_cont(valor, [0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM g),
        c AS (SELECT d, count(*) AS n FROM g GROUP BY 1),
        m AS (SELECT id, valor, ln(1 + valor) AS log_valor, greatest(len(list_filter(e, lambda x: x < valor)) - 1, 0) AS quintil, n AS frecuencia,
            day(f) AS dia, month(f) AS mes, isodow(f) - 1 AS dia_semana, quarter(f) AS trimestre, weekofyear(f) AS semana,
            CASE WHEN isodow(f) >= 6 THEN 1 ELSE 0 END AS es_fin_semana FROM g JOIN c USING (d), edges)
        SELECT id, {", ".join(f"round(coalesce(({n} - avg({n}) OVER ()) / stddev_pop({n}) OVER (), 0), 4) + 0.0 AS {n}" for n in MATRIX)} FROM m""",
    )
)
def spending_matrix(spark, sf_dir):
    """The numbers of the scaled ledger matrix, from mixed, year-less and missing dates."""
    raw = tx_raw(spark, sf_dir).select(
        "id",
        F.trim(" Descripcion ").alias("DESCRIPCION"),
        "FECHA",
        F.abs(parse_money(F.col("VALOR"))).alias("VALOR"),
    )
    out = flows.spending_matrix(raw.where("VALOR IS NOT NULL"), default_year=2024)
    return out.select("id", *[(F.round(F.col("v")[i], 4) + 0.0).alias(n) for i, n in enumerate(MATRIX)])


@query(
    with_sql(
        TX,
        """, counts AS (SELECT descripcion, count(*) AS n FROM tx WHERE valor >= 0 AND descripcion <> 'red gear' GROUP BY 1)
        SELECT id, coalesce(n, 1) AS frecuencia_desc FROM tx LEFT JOIN counts USING (descripcion)""",
    )
)
def lookup_frequency(spark, sf_dir):
    rows = tx(spark, sf_dir)
    source = rows.where((F.col("valor") >= 0) & (F.col("descripcion") != "red gear"))
    out = features.add_frequency(rows, "descripcion", "frecuencia_desc", source)
    return out.select("id", "frecuencia_desc")


@query(
    with_sql(
        OUT,
        """SELECT id, es_gasto_hormiga, valor_abs, CAST(day(fecha) AS INTEGER) AS dia,
        CAST(month(fecha) AS INTEGER) AS mes, CAST(isodow(fecha) - 1 AS INTEGER) AS dia_semana,
        CAST(quarter(fecha) AS INTEGER) AS trimestre, CAST(week(fecha) AS INTEGER) AS semana,
        CAST(CASE WHEN isodow(fecha) >= 6 THEN 1 ELSE 0 END AS INTEGER) AS es_fin_semana, fecha AS fecha_dia,
        round(ln(1 + valor_abs), 6) AS log_valor, count(*) OVER (PARTITION BY fecha) AS freq_gastos_dia,
        round(sum(valor_abs) OVER (PARTITION BY fecha), 2) AS gasto_diario_acumulado,
        count(*) OVER (PARTITION BY descripcion) AS freq_por_descripcion,
        round(sum(valor_abs) OVER (PARTITION BY descripcion), 2) / count(*) OVER (PARTITION BY descripcion) AS gasto_promedio_descripcion FROM gastos""",
    )
)
def feature_pipeline(spark, sf_dir):
    out = features.spending_features(outflows(spark, sf_dir))
    return out.drop("k", "fecha", "descripcion", "valor").withColumns(
        {
            "log_valor": F.round("log_valor", 6),
            "gasto_diario_acumulado": F.round("gasto_diario_acumulado", 2),
            "gasto_promedio_descripcion": exact_mean(
                "gasto_promedio_descripcion", "freq_por_descripcion"
            ),
        }
    )


@query(
    with_sql(
        OUT,
        """, edges AS (SELECT list_sort(list_distinct(quantile_cont(valor_abs, [0, 0.2, 0.4, 0.6, 0.8, 1.0]))) AS e FROM gastos)
        SELECT id, CAST(greatest(len([x for x in e if x < valor_abs]) - 1, 0) AS INTEGER) AS quintil
        FROM gastos, edges""",
    )
)
def quantile_bins(spark, sf_dir):
    spent = outflows(spark, sf_dir)
    return features.add_quantile_bin(spent, "valor_abs", 5, "quintil").select("id", "quintil")


@query(
    with_sql(
        OUT,
        """, r AS (SELECT valor_abs, row_number() OVER (ORDER BY valor_abs) - 1 AS i, count(*) OVER () AS n FROM gastos)
        SELECT (SELECT valor_abs FROM r WHERE i = CAST(floor(n * 0.9) AS BIGINT)) AS by_index,
        round(quantile_cont(valor_abs, 0.9), 6) AS by_interpolation,
        round(quantile_cont(valor_abs, 0.75), 6) AS upper_quartile FROM gastos""",
    )
)
def kth_order_statistic(spark, sf_dir):
    spent = outflows(spark, sf_dir)
    index = exact_quantiles(spent, ["valor_abs"], [0.9], method="index")
    linear = exact_quantiles(spent, ["valor_abs"], [0.75, 0.9])

    def at(p):
        return F.max(F.when(F.col("prob") == p, F.round("value", 6)))

    out = linear.agg(at(0.9).alias("by_interpolation"), at(0.75).alias("upper_quartile"))
    return out.withColumn("by_index", index.select("value").scalar())


TOP = OUT + """, top AS (SELECT descripcion FROM gastos GROUP BY 1 ORDER BY count(*) DESC, descripcion LIMIT 10)"""


@query(
    with_sql(
        TOP,
        """SELECT descripcion, es_gasto_hormiga, count(*) AS conteo FROM gastos
        WHERE descripcion IN (SELECT descripcion FROM top) GROUP BY ALL""",
    )
)
def top_descriptions_by_label(spark, sf_dir):
    return charts.top_groups(outflows(spark, sf_dir), "descripcion", "es_gasto_hormiga", 10)


@query(
    with_sql(
        OUT,
        """SELECT id, valor_abs, es_gasto_hormiga FROM gastos ORDER BY md5(concat('42:', id)) LIMIT 2000""",
    )
)
def seeded_sample(spark, sf_dir):
    spent = outflows(spark, sf_dir)
    return charts.scatter_series(spent, "id", ["valor_abs"], "es_gasto_hormiga", 2000, seed=42)


@query(
    with_sql(
        OUT,
        """SELECT fecha, es_gasto_hormiga, round(sum(valor_abs), 2) AS total, count(*) AS n FROM gastos GROUP BY ALL""",
    )
)
def daily_series(spark, sf_dir):
    out = charts.daily_series(outflows(spark, sf_dir), "fecha", "es_gasto_hormiga", "valor_abs")
    return out.select("fecha", "es_gasto_hormiga", F.round("_total", 2).alias("total"), "n")


@query(
    with_sql(
        OUT,
        """SELECT es_gasto_hormiga, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct
        FROM gastos GROUP BY es_gasto_hormiga""",
    )
)
def count_bars(spark, sf_dir):
    return profile.frequency_table(outflows(spark, sf_dir), "es_gasto_hormiga")


@query(
    with_sql(
        OUT,
        """, e AS (SELECT es_gasto_hormiga, min(valor_abs) AS lo, (max(valor_abs) - min(valor_abs)) / 40 AS w FROM gastos GROUP BY 1)
        SELECT es_gasto_hormiga, CAST(least(floor((valor_abs - lo) / w), 39) AS INTEGER) AS bin, count(*) AS n,
        round(min(lo) + w * CAST(least(floor((valor_abs - lo) / w), 39) AS INTEGER), 6) AS left_edge
        FROM gastos JOIN e USING (es_gasto_hormiga) GROUP BY es_gasto_hormiga, bin, w""",
    )
)
def histogram_by_class(spark, sf_dir):
    return charts.histogram(outflows(spark, sf_dir), "valor_abs", 40, by="es_gasto_hormiga")


@query(
    with_sql(
        OUT,
        """, small AS (SELECT * FROM gastos WHERE valor_abs <= 60000),
        q AS (SELECT es_gasto_hormiga, quantile_cont(valor_abs, 0.25) AS q1, quantile_cont(valor_abs, 0.5) AS median,
              quantile_cont(valor_abs, 0.75) AS q3 FROM small GROUP BY 1)
        SELECT es_gasto_hormiga, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
        min(CASE WHEN valor_abs >= q1 - 1.5 * (q3 - q1) THEN valor_abs END) AS low_whisker,
        max(CASE WHEN valor_abs <= q3 + 1.5 * (q3 - q1) THEN valor_abs END) AS high_whisker,
        count(CASE WHEN valor_abs < q1 - 1.5 * (q3 - q1) OR valor_abs > q3 + 1.5 * (q3 - q1) THEN 1 END) AS fliers,
        count(*) AS n FROM small JOIN q USING (es_gasto_hormiga) GROUP BY es_gasto_hormiga, q.q1, q.median, q.q3""",
    )
)
def box_stats(spark, sf_dir):
    small = outflows(spark, sf_dir).where(F.col("valor_abs") <= 60_000)
    return charts.box_stats(small, "valor_abs", "es_gasto_hormiga")


def _tfidf_sql(base: str, top: int, where: str) -> str:
    return f"""{base}
    , toks AS (SELECT id, unnest(regexp_extract_all(lower(regexp_replace(body, '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g')), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM src),
    tf AS (SELECT id, term, count(*) AS tf FROM toks WHERE {where} GROUP BY 1, 2),
    vocab AS (SELECT term, count(*) AS df FROM tf GROUP BY 1 ORDER BY sum(tf) DESC, term LIMIT {top}),
    n AS (SELECT count(*) AS n FROM src),
    w AS (SELECT id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM tf JOIN vocab USING (term), n),
    norm AS (SELECT id, sqrt(sum(w * w)) AS len FROM w GROUP BY 1)
    SELECT id, term, round(w / len, 6) AS weight FROM w JOIN norm USING (id)"""


@query(
    with_sql(
        TX,
        _tfidf_sql(
            """, src AS (SELECT id, upper(trim(descripcion)) AS body FROM tx)""",
            10,
            "term NOT IN ('the', 'old', 'hot')",
        ),
    )
)
def tfidf_top_terms(spark, sf_dir):
    rows = tx(spark, sf_dir).withColumn(
        "body", strip_punctuation(clean_text(F.col("descripcion"), upper=True))
    )
    out = text.tfidf(rows, "id", "body", 10, stop_words=["the", "old", "hot"])
    return out.select("id", "term", F.round("weight", 6).alias("weight"))


WIDE_TERMS = ["blue", "cold", "large", "new", "red", "small"]


@query(
    with_sql(
        TX,
        """, src AS (SELECT id, string_split(descripcion, ' ')[1] AS term, string_split(descripcion, ' ')[2] AS other FROM tx),
        df AS (SELECT term, count(*) AS df FROM src GROUP BY 1)
        SELECT id, """
        + ", ".join(f"CAST(CASE WHEN term = '{t}' THEN 1 ELSE 0 END AS DOUBLE) AS \"TFIDF_{t}\"" for t in WIDE_TERMS)
        + " FROM src",
    )
)
def tfidf_wide(spark, sf_dir):
    """Weights of the adjectives as columns; each description has one, so its weight is 1."""
    rows = tx(spark, sf_dir)
    nouns = ["anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget", "hot", "old"]
    wide = text.tfidf_columns(rows, "descripcion", 6, nouns)
    return wide.select("id", *prep.feature_columns(wide, "TFIDF_", []))


@query(
    with_sql(
        "src AS (SELECT doc_id AS id, text AS body FROM documents)",
        _tfidf_sql("", 50, "true"),
    )
)
def tfidf_documents(spark, sf_dir):
    """The same weights over the whole texts of all documents."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), strip_punctuation(F.col("text")).alias("body")
    )
    out = text.tfidf(docs, "id", "body", 50, stop_words=[])
    return out.select("id", "term", F.round("weight", 6).alias("weight"))


@query(
    with_sql(
        OUT,
        """SELECT es_gasto_hormiga, round(sum(valor_abs), 2) / count(*) AS mean, min(valor_abs) AS min, max(valor_abs) AS max, count(*) AS n
        FROM gastos GROUP BY es_gasto_hormiga""",
    )
)
def amount_summary(spark, sf_dir):
    spent = outflows(spark, sf_dir)
    return spent.groupBy("es_gasto_hormiga").agg(
        F.avg("valor_abs").alias("mean"),
        F.min("valor_abs").alias("min"),
        F.max("valor_abs").alias("max"),
        F.count(F.lit(1)).alias("n"),
    ).withColumn("mean", exact_mean("mean", "n"))
