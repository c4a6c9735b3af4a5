"""Mixing of sources to target weights by Poisson replication.

The mean repetition of a source is its share of the target divided by its size. The count
of a document is the inverse of the Poisson distribution with that mean at a number in
[0, 1) hashed from seed and ``doc_id``, so it depends on no other row, no partition and no
retry. Each document is exploded by its count, and the copies are dealt out and sorted by
a hash of seed, document and copy, which is a random order of the whole output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketry.functions.sizing import broadcast_within
from basketry.llm.tasks import table

ALPHA = 0.5
SEED = 17
_HASH_DIGITS = 13  # 52 bits fit a double


def source_rates(docs: DataFrame, weights: dict[str, float] | None, target: int | None) -> DataFrame:
    """Mean repetition ``mix_rate`` per source.

    ``weights`` gives the target share of each source (others: none); without it a source
    weighs its size to the power ``ALPHA``. ``target`` is the mean number of output rows,
    the number of input rows if absent. A null source is a source like any other.
    """
    sizes = docs.groupBy(F.col("source").alias("mix_source")).agg(F.count("*").alias("mix_size"))
    if weights is None:
        weight = F.pow(F.col("mix_size").cast("double"), F.lit(ALPHA))
    else:
        pairs = [F.lit(x) for pair in weights.items() for x in pair]
        known = F.create_map(*pairs)[F.coalesce("mix_source", F.lit(""))] if pairs else F.lit(None)
        weight = F.coalesce(known.cast("double"), F.lit(0.0))
    weighed = sizes.withColumn("mix_weight", weight)
    totals = weighed.agg(
        F.sum("mix_weight").alias("weights"), F.sum("mix_size").alias("rows")
    ).first()
    goal = float(target if target is not None else totals["rows"] or 0)
    share = F.col("mix_weight") / F.lit(totals["weights"] or 1.0)
    return weighed.select(
        "mix_source", (share * F.lit(goal) / F.col("mix_size")).alias("mix_rate")
    )


def _cumulative(rate: Column) -> Column:
    """Poisson distribution function at 0, 1, … up to where the rest is below 2^-53."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct(
        (-rate).alias("log"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("all")
    )

    def add(state: Column, k: Column) -> Column:
        log = state["log"] + F.ln(rate) - F.ln(k.cast("double"))
        total = state["sum"] + F.exp(log)
        return F.struct(
            log.alias("log"), total.alias("sum"), F.concat(state["all"], F.array(total)).alias("all")
        )

    table_ = F.aggregate(F.sequence(F.lit(1), last), start, add, lambda state: state["all"])
    return F.when(rate > 0, table_).otherwise(F.array(F.lit(1.0)))


def _digest(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    target: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Rows of ``docs`` repeated to the target weights of their sources, in random order.

    Added columns: ``copy_no`` from 1, ``mix_rate`` (mean repetition) and ``mix_key``
    (the order); input columns of these names are replaced. Rows with one ``doc_id`` share
    a count, a null id counts as an id of its own. An empty table gives an empty table.
    Only per-source sizes are shuffled before the final shuffle; a source's rate reaches
    its documents by broadcast within a measured size, by a shuffled join beyond it.
    """
    rates = source_rates(docs, weights, target).withColumn(
        "mix_cdf", _cumulative(F.col("mix_rate"))
    )
    given = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("mix_row")
    rows = docs.select(given, F.col("source").alias("mix_from"), F.col("doc_id").alias("mix_id"))
    # A source's table of probabilities is short text for the measure: 16 bytes a value.
    joined = rows.join(
        broadcast_within(rates), F.col("mix_from").eqNullSafe(F.col("mix_source"))
    )
    key = F.coalesce(F.col("mix_id").cast("string"), F.lit("null"))
    uniform = F.conv(F.substring(_digest(F.lit(seed), key), 1, _HASH_DIGITS), 16, 10).cast(
        "double"
    ) / F.lit(float(16**_HASH_DIGITS))
    drawn = joined.withColumn("mix_draw", uniform).withColumn(
        "mix_count", F.expr("size(filter(mix_cdf, c -> c <= mix_draw))")
    )
    copies = drawn.where("mix_count > 0").select(
        "mix_row", "mix_rate", key.alias("mix_id"), F.explode(F.sequence(F.lit(1), "mix_count")).alias("copy_no")
    )
    kept = [c for c in docs.columns if c not in ("copy_no", "mix_rate", "mix_key")]
    order = _digest(F.lit(seed), F.lit("order"), F.col("mix_id"), F.col("copy_no"))
    return (
        copies.select(
            *[F.col("mix_row")[c].alias(c) for c in kept],
            "copy_no",
            "mix_rate",
            order.alias("mix_key"),
        )
        .repartition("mix_key")
        .sortWithinPartitions("mix_key")
    )


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.withColumn("mix_rate", F.round("mix_rate", 9))


OP8_SQL = f"""
WITH sizes AS (SELECT source, count(*) AS size FROM documents GROUP BY source),
totals AS (SELECT sum(pow(size::DOUBLE, {ALPHA})) AS weights, sum(size)::DOUBLE AS goal FROM sizes),
rates AS (
  SELECT source, pow(size::DOUBLE, {ALPHA}) / weights * goal / size AS rate FROM sizes, totals
),
terms AS (
  SELECT source, rate, k,
         sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf
  FROM rates, (SELECT unnest(range(0, 400)) AS k)
),
draws AS (
  SELECT *, (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, {_HASH_DIGITS}))::BIGINT)::DOUBLE
            / {float(16**_HASH_DIGITS)!r} AS u
  FROM documents
),
counts AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, t.rate, count(*) FILTER (WHERE t.cdf <= d.u) AS n
  FROM draws d JOIN terms t ON d.source IS NOT DISTINCT FROM t.source
  GROUP BY d.doc_id, d.text, d.lang, d.source, d.n_chars, t.rate
),
copies AS (SELECT *, unnest(range(1, n + 1)) AS copy_no FROM counts WHERE n > 0)
SELECT doc_id, text, lang, source, n_chars, copy_no::INTEGER AS copy_no, round(rate, 9) AS mix_rate,
       md5('{SEED}:order:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy_no) AS mix_key
FROM copies
"""
