"""Named queries over the given tables, each ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.functions.columns import SEGMENTS
from basketry.functions.quantiles import exact_quantiles
from basketry.functions.storage import Scratch, transient_shuffles
from basketry.operators import insights, people, rfm, segments
from basketry.operators.scoring import SCORES, score_customers
from basketry.operators.dataset import RetailTables
from basketry.plans import fixtures, jobs
from basketry.sources.readers import (
    read_classification,
    read_customers,
    read_predictions,
    read_products,
    read_stores,
    read_thresholds,
    read_tickets,
)
from basketry.sources.writers import write_thresholds

Query = Callable[[SparkSession, str], DataFrame]

# Percentiles of the production call.
PERCENTILES = {"r_percentile": 0.95, "f_percentile": 0.99, "m_percentile": 0.99}


def _rounded(df: DataFrame, places: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def _written_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFM table for queries that pass over it several times."""
    return rfm.rfm(fixtures.tickets(spark, sf_dir))


def _bounded(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, rfm.Bounds]:
    table = _written_rfm(spark, sf_dir)
    return table, rfm.trim_bounds(table, **PERCENTILES)


def _quartiles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, rfm.Thresholds]:
    table, bounds = _bounded(spark, sf_dir)
    return table, rfm.thresholds(rfm.trim(table, bounds))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_customers(*_quartiles(spark, sf_dir))


def ticket_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = rfm.written_lines(fixtures.tickets(spark, sf_dir), Scratch(spark))
    amounts = ("extendedamount", "originalamount", "totaldiscount")
    return lines.withColumns(
        {"date": F.col("date").cast("string"), **{a: F.col(a).cast("double") for a in amounts}}
    )


def rfm_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.rfm(fixtures.tickets(spark, sf_dir))


# Compressed files cannot be split, so their number of lines bounds what a task reads.
FILE_LINES = 50_000
COMPRESSION = "gzip"


def _write_tickets(tickets: DataFrame, path: str) -> None:
    """Ticket files as a batch would get them: compressed JSON, each of few lines. The shuffle
    files of the tickets go with the write."""
    with transient_shuffles(tickets.sparkSession):
        tickets.write.option("compression", COMPRESSION).option("maxRecordsPerFile", FILE_LINES).json(path)


def json_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFM of ticket lines that went through JSON with a number in each line.

    Lines that differ only in that number are different lines."""
    path = f"{Scratch(spark).folder}/tickets"
    _write_tickets(fixtures.tickets(spark, sf_dir, numbered=True), path)
    return rfm.rfm(read_tickets(spark, path))


def rfm_trim_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.bounds_frame(spark, _bounded(spark, sf_dir)[1])


def rfm_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.trim(*_bounded(spark, sf_dir))


def rfm_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.outliers(*_bounded(spark, sf_dir))


def rfm_trim_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.trim_audit(*_bounded(spark, sf_dir))


def rfm_thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.thresholds_frame(spark, _quartiles(spark, sf_dir)[1])


def rfm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir)


def standardised_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    features, _ = segments.standardise(_scored(spark, sf_dir))
    scaled = vector_to_array("scaled_features")
    return features.select(
        "customerid", *[F.round(F.get(scaled, i), 6).alias(f"{s}_scaled") for i, s in enumerate(SCORES)]
    )


def seed_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.seed_scores(_scored(spark, sf_dir))


def _labels(labelled: DataFrame) -> DataFrame:
    return labelled.select("customerid", "rfm_score", "prediction", "segmento", "prediction_label")


def seed_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir)
    features, scaler = segments.standardise(scored)
    seeds = segments.scaled_seeds(segments.seed_scores(scored), scaler)
    return _labels(segments.assign(features, seeds))


def segments_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored(spark, sf_dir)
    features, scaler = segments.standardise(scored)
    seeds = segments.scaled_seeds(segments.seed_scores(scored), scaler)
    fit = segments.fit_segments(features, seeds)
    return _labels(segments.assign(features, fit.centroids))


# Middles of six equal parts, to two digits.
MIDDLES = (0.08, 0.25, 0.42, 0.58, 0.75, 0.92)


def _metric_fit(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, segments.Fit]:
    """K-Means of the standardised metrics themselves, from quantiles as seeds."""
    table = _written_rfm(spark, sf_dir)
    assembled = segments.assemble_metrics(table)
    scaler = segments.fit_scaler(assembled)
    features = scaler.transform(assembled)
    at = exact_quantiles(table, rfm.METRICS, MIDDLES)
    seeds = [
        [(at[m][k] - mean) / std for m, mean, std in zip(rfm.METRICS, scaler.mean, scaler.std)]
        for k in range(len(MIDDLES))
    ]
    return features, segments.fit_segments(features, seeds)


def metrics_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all customers by unscored recency, frequency and amount."""
    features, fit = _metric_fit(spark, sf_dir)
    labelled = segments.assign(features, fit.centroids, decimals=None)
    return labelled.select("customerid", "recency", "frequency", "monetary", "prediction", "segmento")


def metrics_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centres of the same clusters on the standardised scale."""
    centers = segments.centroid_frame(spark, _metric_fit(spark, sf_dir)[1].centroids)
    return _rounded(centers, 6, *[c for c in centers.columns if dict(centers.dtypes)[c] == "double"])


def score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores with thresholds that went through a file, as a later batch would."""
    table, quartiles = _quartiles(spark, sf_dir)
    path = f"{Scratch(spark).folder}/thresholds"
    write_thresholds(spark, quartiles, path)
    return score_customers(table, read_thresholds(spark, path))


def _trained(spark: SparkSession, sf_dir: str, **layout: bool) -> str:
    """Folder with ticket files and all that the training job made of them."""
    folder = Scratch(spark).folder
    _write_tickets(fixtures.tickets(spark, sf_dir), f"{folder}/tickets")
    jobs.train(
        spark,
        input=f"{folder}/tickets",
        model_output=f"{folder}/model",
        quartile_output=f"{folder}/quartiles",
        prediction_output=f"{folder}/trained",
        prediction_compression=COMPRESSION,
        **PERCENTILES,
        **layout,
    )
    return folder


def _batch_labelled(spark: SparkSession, sf_dir: str, **layout: bool) -> DataFrame:
    """Labels of the batch job with the saved thresholds and model of the training job."""
    folder = _trained(spark, sf_dir, **layout)
    jobs.run(
        spark,
        input=f"{folder}/tickets",
        model_input=f"{folder}/model",
        quartile_input=f"{folder}/quartiles",
        prediction_output=f"{folder}/batch",
        prediction_compression=COMPRESSION,
        **layout,
    )
    return _labels(read_predictions(spark, f"{folder}/batch/all"))


def train_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the training job wrote for all customers, from ticket files on."""
    return read_predictions(spark, f"{_trained(spark, sf_dir)}/trained/all").drop("features", "scaled_features")


def train_segments_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training job's split by segment; names and rows as the folders have them."""
    path = f"{_trained(spark, sf_dir)}/trained/segments"
    return _labels(read_predictions(spark, path))


def train_plain_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same split as one plain folder per segment, read with one glob."""
    folder = _trained(spark, sf_dir, plain_folders=True)
    names = ",".join(SEGMENTS)
    return _labels(read_predictions(spark, f"{folder}/trained/{{{names}}}"))


def run_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch_labelled(spark, sf_dir)


def run_threshold_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with thresholds that went through CSV folders."""
    return _batch_labelled(spark, sf_dir, quartile_folders=True)


def reports_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Health shares from tables that all went through files of their own formats."""
    folder = Scratch(spark).folder
    given = fixtures.retail_tables(spark, sf_dir)
    _write_tickets(given.tickets, f"{folder}/tickets")
    for name in ("predictions", "customers", "stores", "products"):
        getattr(given, name).write.json(f"{folder}/{name}")
    given.classification.write.option("header", True).csv(f"{folder}/classification")
    return insights.health_share(
        RetailTables(
            predictions=read_predictions(spark, f"{folder}/predictions"),
            tickets=read_tickets(spark, f"{folder}/tickets"),
            customers=read_customers(spark, f"{folder}/customers"),
            stores=read_stores(spark, f"{folder}/stores"),
            products=read_products(spark, f"{folder}/products"),
            classification=read_classification(spark, f"{folder}/classification"),
        )
    )


def analysis_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    dataset = fixtures.written_tables(spark, sf_dir, Scratch(spark)).dataset()
    amounts = ("extendedamount", "originalamount", "totaldiscount")
    return dataset.withColumns({a: F.col(a).cast("double") for a in amounts})


def spend_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.spend_share(fixtures.predictions(spark, sf_dir))


def customer_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.customer_share(fixtures.predictions(spark, sf_dir))


def rfm_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = insights.rfm_means(fixtures.predictions(spark, sf_dir))
    return _rounded(means, 6, "frequency_avg", "monetary_avg", "recency_avg")


def age_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(insights.age_mean(fixtures.retail_tables(spark, sf_dir)), 6, "age_avg")


def products_per_ticket(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = insights.products_per_ticket(fixtures.retail_tables(spark, sf_dir))
    return _rounded(means, 6, "avg_purchase_count")


def top_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.top_families(insights.family_counts(fixtures.retail_tables(spark, sf_dir)))


def last_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.last_families(insights.family_counts(fixtures.retail_tables(spark, sf_dir)))


def _bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people.customer_bitmaps(fixtures.retail_tables(spark, sf_dir), Scratch(spark))


def city_customers_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report from unions of customer bitmaps."""
    return people.city_customers(_bitmaps(spark, sf_dir))


def age_gender_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people.age_gender_bands(_bitmaps(spark, sf_dir))


def _on_tables(report: Callable[[insights.Source], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(fixtures.retail_tables(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        "ticket_lines": ticket_lines,
        "rfm_table": rfm_table,
        "json_tickets": json_tickets,
        "rfm_trim_bounds": rfm_trim_bounds,
        "rfm_trimmed": rfm_trimmed,
        "rfm_outliers": rfm_outliers,
        "rfm_trim_audit": rfm_trim_audit,
        "rfm_thresholds": rfm_thresholds,
        "rfm_scores": rfm_scores,
        "standardised_scores": standardised_scores,
        "seed_centroids": seed_centroids,
        "seed_assignment": seed_assignment,
        "segments_kmeans": segments_kmeans,
        "metrics_kmeans": metrics_kmeans,
        "metrics_centroids": metrics_centroids,
        "score_batch": score_batch,
        "train_predictions": train_predictions,
        "train_segments_folder": train_segments_folder,
        "train_plain_folders": train_plain_folders,
        "run_predictions": run_predictions,
        "run_threshold_folders": run_threshold_folders,
        "reports_from_files": reports_from_files,
        "analysis_dataset": analysis_dataset,
        "spend_share": spend_share,
        "customer_share": customer_share,
        "rfm_means": rfm_means,
        "age_mean": age_mean,
        "gender_share": _on_tables(insights.gender_share),
        "top_families": top_families,
        "last_families": last_families,
        "products_per_ticket": products_per_ticket,
        "vat_share": _on_tables(insights.vat_share),
        "health_share": _on_tables(insights.health_share),
        "discount_share": _on_tables(insights.discount_share),
        "total_spend_millions": _on_tables(insights.total_spend_millions),
        "top_articles": _on_tables(insights.top_articles),
        "city_customers": _on_tables(insights.city_customers),
        "age_gender_bands": _on_tables(insights.age_gender_bands),
        "city_customers_bitmaps": city_customers_bitmaps,
        "age_gender_bitmaps": age_gender_bitmaps,
    }
