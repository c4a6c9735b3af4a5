"""The batch jobs: train segments, score a batch with saved segments, write reports."""

from __future__ import annotations

import datetime
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from basketry.functions.storage import Scratch
from basketry.operators import insights
from basketry.operators.dataset import RetailTables, WrittenDataset
from basketry.operators.rfm import (
    Bounds,
    Thresholds,
    rfm_batch,
    thresholds,
    trim,
    trim_audit,
    trim_bounds,
)
from basketry.operators.scoring import score_customers
from basketry.operators.segments import Fit, assign, fit_segments, scaled_seeds, seed_scores, standardise
from basketry.sources import readers, writers


@dataclass(frozen=True)
class TrainSummary:
    """What a training run found, apart from its files."""

    bounds: Bounds
    audit: dict[str, int]
    quartiles: Thresholds
    fit: Fit


def train(
    spark: SparkSession,
    input: str,
    model_output: str,
    quartile_output: str,
    prediction_output: str,
    r_percentile: float | None = None,
    f_percentile: float | None = None,
    m_percentile: float | None = None,
    input_format: str = "json",
    as_of: datetime.date | None = None,
    plain_folders: bool = False,
    quartile_folders: bool = False,
    scaler_output: str | None = None,
    prediction_compression: str | None = None,
) -> TrainSummary:
    """Learns thresholds and segments from ticket lines and writes all results.

    The ticket lines are read once. Their aggregate, one row per customer, is written to
    the shared folder and feeds every later pass.
    """
    writers.require_free(spark, model_output)
    with Scratch(spark) as scratch:
        tickets = readers.read_tickets(spark, input, input_format)
        table = rfm_batch(tickets, scratch, as_of).table

        bounds = trim_bounds(table, r_percentile, f_percentile, m_percentile)
        audit = trim_audit(table, bounds).first().asDict()
        quartiles = thresholds(trim(table, bounds))
        if quartile_folders:
            writers.write_threshold_folders(spark, quartiles, quartile_output)
        else:
            writers.write_thresholds(spark, quartiles, quartile_output)

        scored = score_customers(table, quartiles)
        features, scaler = standardise(scored)
        if scaler_output:
            writers.write_scaler(scaler, scaler_output)
        fit = fit_segments(features, scaled_seeds(seed_scores(scored), scaler))
        writers.write_model(spark, fit.model, model_output)
        writers.write_predictions(
            assign(features, fit.centroids),
            prediction_output,
            plain_folders=plain_folders,
            compression=prediction_compression,
        )
    return TrainSummary(bounds, audit, quartiles, fit)


def run(
    spark: SparkSession,
    input: str,
    model_input: str,
    quartile_input: str,
    prediction_output: str,
    input_format: str = "json",
    as_of: datetime.date | None = None,
    plain_folders: bool = False,
    quartile_folders: bool = False,
    scaler_input: str | None = None,
    prediction_compression: str | None = None,
) -> None:
    """Labels the customers of a batch with saved thresholds and a saved model.

    Recency counts from the last date of the batch unless ``as_of`` is given. Scores are
    standardised on the batch itself unless ``scaler_input`` names the scaler of training.
    """
    read = readers.read_threshold_folders if quartile_folders else readers.read_thresholds
    quartiles = read(spark, quartile_input)
    centroids = readers.read_centroids(spark, model_input)
    scaler = readers.read_scaler(scaler_input) if scaler_input else None
    with Scratch(spark) as scratch:
        tickets = readers.read_tickets(spark, input, input_format)
        table = rfm_batch(tickets, scratch, as_of).table
        features, _ = standardise(score_customers(table, quartiles), scaler)
        writers.write_predictions(
            assign(features, centroids),
            prediction_output,
            plain_folders=plain_folders,
            compression=prediction_compression,
        )


def reports(
    predictions: DataFrame,
    source: insights.Source,
    people: insights.Source | None = None,
    counts: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All fifteen reports by name.

    ``people`` may serve the reports on ages and genders, ``counts`` may hold the family
    counts; both come from ``source`` if they are not given.
    """
    people = people or source
    counts = insights.family_counts(source) if counts is None else counts
    return {
        "spend_share": insights.spend_share(predictions),
        "customer_share": insights.customer_share(predictions),
        "rfm_means": insights.rfm_means(predictions),
        "age_mean": insights.age_mean(people),
        "gender_share": insights.gender_share(people),
        "top_families": insights.top_families(counts),
        "last_families": insights.last_families(counts),
        "products_per_ticket": insights.products_per_ticket(source),
        "vat_share": insights.vat_share(source),
        "health_share": insights.health_share(source),
        "discount_share": insights.discount_share(source),
        "total_spend_millions": insights.total_spend_millions(source),
        "top_articles": insights.top_articles(source),
        "city_customers": insights.city_customers(source),
        "age_gender_bands": insights.age_gender_bands(people),
    }


def write_reports(
    spark: SparkSession,
    tables: RetailTables,
    output: str,
    fmt: str = "parquet",
    stage_tickets: bool = False,
) -> None:
    """Joins the tables once and writes the reports to one folder each.

    The joined lines keep only the columns that a report reads; customers with age and
    gender are a table of their own. ``stage_tickets`` first copies the tickets to
    Parquet, which pays off when they are read from a row format such as JSON.
    """
    with Scratch(spark) as scratch:
        used = ["customerid", "segmento", "prediction", "recency", "frequency", "monetary"]
        tables = replace(
            tables, predictions=scratch.table(tables.predictions.select(used), "predictions")
        )
        if stage_tickets:
            tables = replace(tables, tickets=scratch.table(tables.tickets, "tickets"))
        people = scratch.table(tables.distinct_rows(*insights.PEOPLE_COLUMNS), "people")
        lines = scratch.table(tables.rows(*insights.LINE_COLUMNS), "lines")
        baskets = scratch.table(WrittenDataset(lines).baskets(), "baskets")
        source = WrittenDataset(lines, baskets)
        counts = scratch.table(insights.family_counts(source), "family_counts")
        written = reports(tables.predictions, source, WrittenDataset(people), counts)
        for name, report in written.items():
            writers.write_report(report, f"{output}/{name}", fmt)
