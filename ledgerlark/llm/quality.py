"""Quality rules: hashed n-gram log-likelihood ratio of trusted text against the raw corpus.

Words and pairs of neighbouring words are hashed into ``buckets``. Two multinomials over the buckets are
estimated, one from trusted texts and one from all texts, both smoothed by ``smoothing`` counts per
bucket. The score of a text is the mean over its n-grams of log(trusted / raw). A text is kept if the base
rules pass and its score reaches ``threshold``; texts below are rejected, always and everywhere the same.

Trusted texts are those labelled with quality 1 among at most ``trusted_limit`` labelled ids, the
first by the hash of the id; that list is the only broadcast. The raw counts cover all texts.

Everything is made of DataFrame expressions. Windows and n-grams are arrays within a row, so nothing
but ``buckets`` counts per task is shuffled.

NULL and empty texts have no words: counts 0, score 0, base_failed true, kept false. Repeated rows give
repeated results and count as often as they stand there. An empty table gives an empty one. Without trusted
texts all scores are 0. Ids that are NULL are never trusted; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlark.llm.common import id_and_text, read
from ledgerlark.llm.registry import query

BUCKETS = 10_000
SMOOTHING = 1.0
THRESHOLD = -0.1
TRUSTED_LIMIT = 50_000
MIN_WORDS = 50

_SPACE = " \t\n\x0b\x0c\r"
_SPACES, _SYMBOLS = "[\x20\x09-\x0d]+", "[#*$%&|<>]+"


def words_of(text: Column) -> Column:
    """Words between blanks, tabs, line feeds up to carriage returns; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SPACES), "")


def base_columns(texts: DataFrame) -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and ``_hash`` (of every word) in place of the
    column ``text``; other columns are passed on."""
    others = [c for c in texts.columns if c != "text"]
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(_SPACE))) > 0)
    hashed = F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w))
    out = texts.select(
        *others,
        F.length(F.regexp_replace(text, _SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        hashed.alias("_hash"),
    )
    # Windows of three words, by the hash of their words, next to the places where they start; sorted, so
    # that equal windows are neighbours.
    windows = F.expr(
        """CASE WHEN size(_hash) > 3 THEN sort_array(transform(slice(_hash, 1, size(_hash) - 2),
             (x, i) -> struct(xxhash64(x, _hash[i + 1], _hash[i + 2]) AS h, i AS i))) END"""
    )
    out = out.withColumn("_windows", windows)
    places = F.expr(
        """sort_array(transform(filter(_windows, (w, j) ->
             w.h = get(_windows, j - 1).h OR w.h = get(_windows, j + 1).h), w -> w.i))"""
    )
    out = out.withColumn("_places", places)
    covered = F.expr(
        """CASE WHEN size(_places) > 0 THEN
             aggregate(_places, struct(0L AS n, -3 AS last),
               (a, p) -> struct(a.n + least(3, p - a.last) AS n, p AS last)).n ELSE 0L END"""
    )
    return out.select(
        *others,
        F.size("_hash").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        "_hash",
    )


def grams(buckets: int) -> Column:
    """Bucket numbers of words and of pairs of neighbours, from ``_hash``."""
    return F.expr(
        f"""concat(transform(_hash, x -> CAST(pmod(x, {buckets}) AS INT)),
              transform(slice(_hash, 1, greatest(size(_hash) - 1, 0)),
                (x, i) -> CAST(pmod(xxhash64(x, _hash[i + 1]), {buckets}) AS INT)))"""
    )


def trusted_ids(labels: DataFrame, limit: int = TRUSTED_LIMIT) -> DataFrame:
    """(doc_id) of at most ``limit`` rows labelled with quality 1, the first by the hash of their id."""
    good = labels.where(F.col("quality") == 1).select(F.col("doc_id").cast("long").alias("doc_id"))
    good = good.where(F.col("doc_id").isNotNull()).distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def ratios(texts: DataFrame, labels: DataFrame, buckets: int, smoothing: float, trusted_limit: int) -> DataFrame:
    """One row with the array of log ratios of all buckets."""
    mine = F.broadcast(trusted_ids(labels, trusted_limit).withColumn("_trusted", F.lit(1)))
    hashed = texts.select("doc_id", F.transform(words_of(F.col("text")), lambda w: F.xxhash64(w)).alias("_hash"))
    counts = (
        hashed.join(mine, "doc_id", "left")
        .select("_trusted", F.explode(grams(buckets)).alias("bucket"))
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("raw"), F.count("_trusted").alias("trusted"))
    )
    spark = texts.sparkSession
    full = spark.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    full = full.select("bucket", F.coalesce("raw", F.lit(0)).alias("raw"), F.coalesce("trusted", F.lit(0)).alias("trusted"))
    lists = full.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "trusted", "raw"))).alias("c"),
        F.sum("trusted").alias("t"),
        F.sum("raw").alias("r"),
    )
    ratio = F.transform(
        "c",
        lambda x: F.when(
            F.col("t") > 0,
            F.log((x["trusted"] + smoothing) / (F.col("t") + smoothing * buckets))
            - F.log((x["raw"] + smoothing) / (F.col("r") + smoothing * buckets)),
        ).otherwise(F.lit(0.0)),
    )
    return lists.select(ratio.alias("ratios"))


def _judged(
    texts: DataFrame, labels: DataFrame, buckets: int, smoothing: float, threshold: float, trusted_limit: int, min_words: int
) -> DataFrame:
    table = ratios(texts, labels, buckets, smoothing, trusted_limit).scalar()
    measured = base_columns(texts).withColumn("_grams", grams(buckets)).withColumn("_table", table)
    total = F.expr("aggregate(_grams, 0D, (a, g) -> a + _table[g])")
    score = F.when(F.size("_grams") > 0, total / F.size("_grams")).otherwise(F.lit(0.0))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = measured.withColumn("score", score).withColumn("base_failed", failed)
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold)).drop("_grams", "_table", "_hash")
    # A generator of one row: no filter on the verdict moves below it, where the optimiser would copy into the filter
    # every expression whose results the projections share.
    return judged.select(F.inline(F.array(F.struct(*judged.columns))))


def judge(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING,
    threshold: float = THRESHOLD, trusted_limit: int = TRUSTED_LIMIT, min_words: int = MIN_WORDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per row: the base measures, base_failed, kept, and the mean log ratio ``score``."""
    texts = id_and_text(docs, id_col, text_col)
    return _judged(texts, labels, buckets, smoothing, threshold, trusted_limit, min_words).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score",
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, smoothing: float = SMOOTHING,
    threshold: float = THRESHOLD, trusted_limit: int = TRUSTED_LIMIT, min_words: int = MIN_WORDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows that ``judge`` keeps, with all their columns."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.struct("*").alias("_row")
    )
    judged = _judged(texts, labels, buckets, smoothing, threshold, trusted_limit, min_words)
    return judged.where("kept").select("_row.*")


@query()
def op3_quality(spark, sf_dir):
    return judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
