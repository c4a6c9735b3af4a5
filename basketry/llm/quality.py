"""Quality rules: fixed limits, then robust multivariate outliers per language and source.

Everything is SQL and DataFrame functions. Word statistics come from array functions over
the words of a text, in one narrow pass. Each document becomes a short vector of
transformed statistics in whole numbers (fixed point, so sums are exact and repeatable).
Per language and source, the minimum covariance determinant is sought by concentration
steps: from medians and absolute deviations, repeatedly take the ``support`` share of the
documents nearest to the centre and their mean and covariance, until the determinants settle.
A document is rejected when its Mahalanobis distance from that estimate is too large.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from basketry.functions.sizing import broadcast_within
from basketry.functions.storage import Scratch
from basketry.llm.tasks import table

SETTLED = 1000  # millionths by which a group's log-determinant has to fall to go on
ALL = '["all",null,null]'  # name of the group of all documents
UNIT = 1024  # fixed point of the transformed statistics
_BLANK = r"[\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\x0c\r"
_INDEX_BITS = 30  # a text of 2^31 bytes has fewer words


@dataclass(frozen=True)
class Rules:
    """``support``: share of a group in the estimate; ``least_rows``: smaller groups are
    judged by those of their language, then by all; ``floors``: added standard deviations of the
    statistics, so that a usual constant rejects no small departure; ``limit``: largest
    accepted distance, in robust standard deviations; ``steps``: concentration steps at most,
    a guard that no table has come near."""

    least_words: int = 50
    most_repeat_pct: int = 50
    support: float = 0.75
    least_rows: int = 100
    floors: tuple[float, ...] = (0.03, 0.03, 0.1, 0.1, 0.03, 0.06)
    limit: float = 6.0
    steps: int = 100


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, though named several times inside."""
    return F.get(F.transform(F.array(value), use), 0)


def _repeat_words(words: Column, n_words: Column) -> Column:
    """Words inside three-word windows that the text holds twice or more.

    Windows are first sorted by a hash packed with their place; only those whose hash has
    a neighbour are compared word by word, so a colliding hash changes nothing.
    """
    mask = F.lit((1 << _INDEX_BITS) - 1)
    high = F.lit(~((1 << _INDEX_BITS) - 1))

    def at(i: Column, k: int) -> Column:
        return F.get(words, i + k)

    packed = F.transform(
        F.sequence(F.lit(0), (n_words - 3).cast("int")),
        lambda i: F.xxhash64(at(i, 0), at(i, 1), at(i, 2)).bitwiseAND(high).bitwiseOR(i.cast("long")),
    )

    def paired(found: Column, same) -> Column:
        """Elements of a sorted array that equal a neighbour in the sense of ``same``."""
        return F.filter(
            found,
            lambda x, j: ((j > 0) & F.coalesce(same(x, F.get(found, j - 1)), F.lit(False)))
            | F.coalesce(same(x, F.get(found, j + 1)), F.lit(False)),
        )

    near = _bind(F.sort_array(packed), lambda s: paired(s, lambda x, y: x.bitwiseAND(high) == y.bitwiseAND(high)))
    windows = F.transform(
        near,
        lambda x: _bind(
            x.bitwiseAND(mask).cast("int"),
            lambda i: F.struct(at(i, 0).alias("a"), at(i, 1).alias("b"), at(i, 2).alias("c"), i.alias("i")),
        ),
    )
    equal = _bind(
        F.array_sort(windows),
        lambda s: paired(s, lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])),
    )
    places = F.sort_array(F.transform(equal, lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
        lambda s, p: F.struct((s["n"] + F.least(F.lit(3), p - s["last"])).alias("n"), p.alias("last")),
        lambda s: s["n"],
    )
    return F.when(n_words >= 4, covered).otherwise(F.lit(0).cast("long"))


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_HELPERS = ("n_lines", "n_upper", "n_marks")


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base statistics and three more for the vector; null is empty."""
    value = F.coalesce(F.col(text), F.lit(""))
    trimmed = F.btrim(value, F.lit(_BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _BLANK))
    lines = F.filter(F.split(value, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.withColumns({"q_words": words, "q_lines": lines}).withColumns(
        {
            "n_words": F.size("q_words").cast("long"),
            "word_chars": F.length(F.array_join("q_words", "")).cast("long"),
            "n_lines": F.size("q_lines").cast("long"),
            "n_dup_lines": (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long"),
            "n_symbols": F.length(F.regexp_replace(value, r"[^#*$%&|<>]+", "")).cast("long"),
            "n_upper": F.length(F.regexp_replace(value, r"[^A-Z]+", "")).cast("long"),
            "n_marks": F.length(F.regexp_replace(value, r"[^!?:;0-9]+", "")).cast("long"),
        }
    )
    repeats = _bind(F.col("q_words"), lambda w: _repeat_words(w, F.size(w)))
    # A filter on the statistics stays above ``q_row_no``, so nothing is computed twice for it.
    found = counted.withColumns(
        {"n_repeat_words": repeats, "q_row_no": F.monotonically_increasing_id()}
    )
    return found.drop("q_words", "q_lines")


def with_base(docs: DataFrame, rules: Rules) -> DataFrame:
    failed = (F.col("n_words") < rules.least_words) | (
        100 * F.col("n_repeat_words") > rules.most_repeat_pct * F.col("n_words")
    )
    return docs.withColumn("base_failed", failed)


def _vector() -> list[Column]:
    """Transformed statistics, each shrunk towards a usual value where the text is short."""

    def share(part: str, whole: str, prior: int) -> Column:
        return F.sqrt(F.col(part) / (F.col(whole) + F.lit(prior)))

    values = [
        F.ln((F.col("word_chars") + 1000) / (F.col("n_words") + 200)),
        share("n_symbols", "word_chars", 500),
        share("n_dup_lines", "n_lines", 10),
        share("n_repeat_words", "n_words", 100),
        share("n_upper", "word_chars", 500),
        share("n_marks", "word_chars", 500),
    ]
    return [F.round(v * UNIT).cast("long") for v in values]


SIZE = 6  # values of the vector
_X = [f"x{i}" for i in range(SIZE)]
_LOWER = [(i, j) for i in range(SIZE) for j in range(i + 1)]


def with_vector(docs: DataFrame) -> DataFrame:
    return docs.withColumns(dict(zip(_X, _vector())))


def group_names(vectors: DataFrame, rules: Rules) -> DataFrame:
    """``lang``, ``source``, the name ``grp`` of the group that judges the pair, and ``feeds``,
    the groups of the language in which its documents count.

    A pair of fewer than ``least_rows`` is judged with the other such pairs of its language;
    where these are too few, by all documents of the language; where these are too few, by
    all documents (``ALL``). Only groups that judge some pair are listed.
    """
    sizes = vectors.groupBy("lang", "source").agg(F.count("*").alias("n"))
    own = Window.partitionBy("lang")
    none = F.lit(None).cast("string")
    sizes = sizes.withColumns(
        {
            "pool": F.sum(F.when(F.col("n") < rules.least_rows, F.col("n")).otherwise(0)).over(own),
            "whole": F.sum("n").over(own),
        }
    )
    level = (
        F.when(F.col("n") >= rules.least_rows, "pair")
        .when(F.col("pool") >= rules.least_rows, "small pairs")
        .when(F.col("whole") >= rules.least_rows, "language")
        .otherwise("all")
    )
    named = sizes.withColumn("level", level)
    names = {
        "pair": F.to_json(F.array(F.lit("pair"), "lang", "source")),
        "small pairs": F.to_json(F.array(F.lit("small pairs"), "lang", none)),
        "language": F.to_json(F.array(F.lit("language"), "lang", none)),
        "all": F.lit(ALL),
    }
    judges = F.coalesce(*[F.when(F.col("level") == k, v) for k, v in names.items()])
    named = named.withColumn("grp", judges)
    language = F.max(F.col("level") == "language").over(own)
    feeds = F.array("grp", F.when(language, names["language"]))
    return named.select("lang", "source", "grp", F.array_distinct(F.filter(feeds, F.isnotnull)).alias("feeds"))


def _matched(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``groups``, joined on language and source, null safe."""
    right = groups.withColumnsRenamed({"lang": "g_lang", "source": "g_source"})
    on = F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source"))
    return docs.join(broadcast_within(right), on, "left").drop("g_lang", "g_source")


def _start(vectors: DataFrame) -> DataFrame:
    """Centre and diagonal factor from medians and median absolute deviations.

    Values are whole numbers in a narrow range, so the exact median keeps few counts."""
    medians = vectors.groupBy("grp").agg(*[F.percentile(x, F.lit(0.5)).alias(f"m{i}") for i, x in enumerate(_X)])
    apart = vectors.join(broadcast_within(medians), "grp")
    return apart.groupBy("grp").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(SIZE)],
        *[(F.percentile(F.abs(F.col(x) - F.col(f"m{i}")), F.lit(0.5)) * 1.4826).alias(f"s{i}") for i, x in enumerate(_X)],
    )


def _as_factor(start: DataFrame, floors: tuple[float, ...]) -> DataFrame:
    return start.select(
        "grp",
        *[f"m{i}" for i in range(SIZE)],
        *[
            (F.greatest(F.col(f"s{i}"), F.lit(floors[i] * UNIT)) if i == j else F.lit(0.0)).alias(f"l{i}_{j}")
            for i, j in _LOWER
        ],
    )


def with_distance(docs: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance ``d2``: forward substitution with the factor."""
    for i in range(SIZE):
        rest = F.col(f"x{i}") - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}_{j}") * F.col(f"y{j}")
        docs = docs.withColumn(f"y{i}", rest / F.col(f"l{i}_{i}"))
    total = reduce(lambda a, b: a + b, [F.col(f"y{i}") * F.col(f"y{i}") for i in range(SIZE)])
    return docs.withColumn("d2", total).drop(*[f"y{i}" for i in range(SIZE)])


def _level(d2: Column) -> Column:
    """Distances in 256 steps per factor of e: few values, in the order of the distance."""
    return F.floor(F.ln(1 + d2) * 256).cast("long")


def concentrate(vectors: DataFrame, factors: DataFrame, rules: Rules) -> DataFrame:
    """One step: mean and Cholesky factor of the ``support`` nearest of each group.

    Rows are first summed per level of distance, with a map-side step, then the levels up
    to the wanted count are summed: no group is sorted or gathered. All rows of the last
    level count, so ties are treated alike.
    """
    near = with_distance(vectors.join(factors, "grp")).withColumn("level", _level(F.col("d2")))
    levels = near.groupBy("grp", "level").agg(
        F.count("*").alias("n"),
        *[F.sum(x).alias(f"t{i}") for i, x in enumerate(_X)],
        *[F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"t{i}_{j}") for i, j in _LOWER],
    )
    whole = "PARTITION BY grp"
    kept = levels.withColumns(
        {
            "before": F.expr(f"coalesce(sum(n) OVER ({whole} ORDER BY level ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"),
            "all_rows": F.expr(f"sum(n) OVER ({whole})"),
        }
    ).where(F.col("before") < F.ceil(F.col("all_rows") * rules.support))
    sums = kept.groupBy("grp").agg(
        F.sum("n").alias("n"),
        F.max("level").alias("level"),
        F.max("all_rows").alias("all_rows"),
        *[F.sum(f"t{i}").alias(f"t{i}") for i in range(SIZE)],
        *[F.sum(f"t{i}_{j}").alias(f"t{i}_{j}") for i, j in _LOWER],
    )
    return _cholesky(sums, rules)


def _cholesky(sums: DataFrame, rules: Rules) -> DataFrame:
    """Means ``m`` and lower factor ``l`` of the covariance plus the floors on its diagonal.

    A group of n rows, fewer than ``least_rows``, has floors greater by the root of
    ``least_rows / n``: few rows say little about how far others lie apart."""
    few = F.greatest(F.lit(1.0), F.lit(float(rules.least_rows)) / F.col("all_rows"))
    found = sums.withColumns({f"m{i}": F.col(f"t{i}") / F.col("n") for i in range(SIZE)})
    for j in range(SIZE):
        for i in range(j, SIZE):
            value = F.col(f"t{i}_{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")
            for k in range(j):
                value = value - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            if i == j:
                value = F.sqrt(F.greatest(value, F.lit(0.0)) + F.lit((rules.floors[i] * UNIT) ** 2) * few)
            else:
                value = value / F.col(f"l{j}_{j}")
            found = found.withColumn(f"l{i}_{j}", value)
    return found.select(
        "grp", "n", "level", "all_rows", *[f"m{i}" for i in range(SIZE)], *[f"l{i}_{j}" for i, j in _LOWER]
    )


def estimates(statistics: DataFrame, rules: Rules, scratch: Scratch) -> DataFrame:
    """Per ``lang`` and ``source``: centre, factor and scale of its group's estimate.

    Only documents that pass the base rules take part. Every step reads the narrow written
    vectors and writes one row per group; the driver sees whether any group goes on. A group
    ends at its own first step that lowers its log-determinant by less than ``SETTLED``, so
    its estimate does not depend on other groups.
    """
    passed = with_vector(statistics.where("NOT base_failed")).select("lang", "source", *_X)
    groups = scratch.table(group_names(passed, rules), "groups")
    feeds = F.col("feeds")
    if not groups.where(F.col("grp") == ALL).isEmpty():
        feeds = F.array_union(feeds, F.array(F.lit(ALL)))
    counted = _matched(passed, groups).select(F.explode(feeds).alias("grp"), *_X)
    vectors = scratch.table(counted, "vectors")
    factors = _as_factor(scratch.table(_start(vectors), "start"), rules.floors)
    factors = factors.withColumn("logs", F.lit(None).cast("long"))
    # In whole millionths, so that equal determinants are equal numbers.
    logs = reduce(lambda a, b: a + b, [F.round(F.ln(f"l{i}_{i}") * 1_000_000).cast("long") for i in range(SIZE)])
    ended = []
    for step in range(rules.steps):
        factors = broadcast_within(factors)
        before = factors.select("grp", F.col("logs").alias("before"))
        stepped = concentrate(vectors, factors.drop("logs"), rules).withColumn("logs", logs).join(before, "grp")
        settled = F.coalesce(F.col("logs") > F.col("before") - SETTLED, F.lit(False))
        found = scratch.table(stepped.withColumn("settled", settled).drop("before"), f"step-{step}")
        ended.append(found.where("settled").drop("settled", "logs"))
        factors = found.where("NOT settled").drop("settled")
        if factors.isEmpty():
            break
    else:
        ended.append(factors.drop("logs"))
    factors = scratch.table(reduce(DataFrame.unionByName, ended), "settled")
    judged = with_distance(vectors.join(broadcast_within(factors), "grp"))
    # The middle of all distances is that of a chi-square with SIZE degrees of freedom.
    scale = judged.groupBy("grp").agg(F.percentile(_level(F.col("d2")), F.lit(0.5)).alias("middle"))
    scaled = scratch.table(
        factors.join(scale, "grp").select(
            "grp",
            *[f"m{i}" for i in range(SIZE)],
            *[f"l{i}_{j}" for i, j in _LOWER],
            F.greatest((F.exp((F.col("middle") + 0.5) / 256) - 1) / F.lit(_chi_middle(SIZE)), F.lit(1.0)).alias("scale"),
        ),
        "scaled",
    )
    named = groups.drop("feeds").join(broadcast_within(scaled), "grp", "left")
    return scratch.table(named, "estimates")


def _chi_middle(k: int) -> float:
    """Median of the chi-square distribution (Wilson and Hilferty)."""
    return k * (1 - 2 / (9 * k)) ** 3


def judge(statistics: DataFrame, found: DataFrame, rules: Rules) -> DataFrame:
    """``statistics`` with ``distance`` and ``kept``.

    Every pair with a document that passes the base rules has an estimate; ``distance`` is
    null only for documents of other pairs, which all fail these rules.
    """
    near = with_distance(_matched(with_vector(statistics), found))
    distance = F.sqrt(F.col("d2") / F.col("scale"))
    kept = ~F.col("base_failed") & F.coalesce(distance <= rules.limit, F.lit(True))
    return near.withColumns({"distance": distance, "kept": kept}).drop(
        "d2", "grp", "scale", *_X, *[f"m{i}" for i in range(SIZE)], *[f"l{i}_{j}" for i, j in _LOWER]
    )


def _measured(docs: DataFrame, rules: Rules, *carried: Column) -> DataFrame:
    rows = docs.select(*carried, F.col("lang"), F.col("source"), F.col("text").alias("q_text"))
    return with_base(with_statistics(rows, "q_text").drop("q_text"), rules)


def quality_rules(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per row of ``docs`` with base statistics, ``base_failed``, ``distance``, ``kept``.

    Null or empty texts have no words and fail. Null languages and sources are groups like
    any other. Repeated rows count as often as they come. An empty table gives an empty
    one. Only ``doc_id``, ``text``, ``lang`` and ``source`` are read. The texts are read
    once; statistics, vectors and estimates are written to the shared folder.
    """
    scratch = Scratch(docs.sparkSession)
    measured = scratch.table(_measured(docs, rules, F.col("doc_id")).drop("q_row_no"), "statistics")
    judged = judge(measured, estimates(measured, rules, scratch), rules)
    return judged.select("doc_id", *STATISTICS, "base_failed", "kept", F.round("distance", 6).alias("distance"))


def keep_quality(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Rows of ``docs`` that :func:`quality_rules` keeps, with all their columns.

    The verdict is computed again beside the text: two narrow passes over the texts cost
    less than shuffling them to a verdict joined by ``doc_id``, and ids may repeat.
    """
    scratch = Scratch(docs.sparkSession)
    measured = scratch.table(_measured(docs, rules).drop("q_row_no"), "statistics")
    found = estimates(measured, rules, scratch)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("q_row")
    judged = judge(_measured(docs, rules, row), found, rules)
    return judged.where("kept AND q_row_no >= 0").select(*[F.col("q_row")[c].alias(c) for c in docs.columns])


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))
