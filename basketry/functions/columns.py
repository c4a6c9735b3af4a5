"""Column rules shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Cluster index of each segment, spelling as in existing outputs.
SEGMENTS = {
    "best": 0,
    "ocassional": 1,
    "loyal": 2,
    "promising": 3,
    "risk": 4,
    "lost": 5,
}

# Age bands by their exclusive upper age, then the band of all others.
AGE_BANDS = {
    18: "Menor de 18",
    35: "Entre 18-34",
    50: "Entre 35-49",
    65: "Entre 50-64",
}
LAST_AGE_BAND = "Mayor de 65"

# Gender codes in the customer table and their names.
GENDERS = {"M": "Male", "F": "Female"}
UNKNOWN_GENDER = "Unknown"

DATE_FORMAT = "yyyy-MM-dd"

# Squared distances which agree to this many decimals count as equal.
TIE_DECIMALS = 9


def purchase_date(datekey: str = "datekey") -> Column:
    """Date of a ticket line; null where the key is no date."""
    return F.try_to_date(F.col(datekey), DATE_FORMAT)


def score(metric: str, quartiles: Sequence[float], ascending: bool) -> Column:
    """Score 1 (best) to 4 (worst) of a metric by how many quartiles it exceeds.

    ``ascending`` means that a small value is good. A null exceeds none.
    """
    exceeded = sum(
        (F.coalesce((F.col(metric) > F.lit(float(q))).cast("int"), F.lit(0)) for q in quartiles),
        F.lit(0),
    )
    return exceeded + 1 if ascending else F.lit(len(quartiles) + 1) - exceeded


def segment_name(prediction: Column) -> Column:
    """Name of a cluster index; an index without a name becomes its own text."""
    names = F.create_map(*[F.lit(x) for name, index in SEGMENTS.items() for x in (index, name)])
    return F.coalesce(F.try_element_at(names, prediction), prediction.cast("string"))


def segment_label(prediction: Column, segment: Column) -> Column:
    """Text such as ``(0) best``."""
    return F.format_string("(%d) %s", prediction, segment)


def gender_name(gender: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in GENDERS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, gender), F.lit(UNKNOWN_GENDER))


def age_band(age: Column) -> Column:
    """Band of an age; a null age falls in the last band."""
    band = F.lit(LAST_AGE_BAND)
    for limit, name in sorted(AGE_BANDS.items(), reverse=True):
        band = F.when(age < limit, F.lit(name)).otherwise(band)
    return band


def ratio(part: Column, whole: Column) -> Column:
    """Quotient in doubles; null where the whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def nearest(
    point: Column, centroids: Sequence[Sequence[float]], decimals: int | None = TIE_DECIMALS
) -> Column:
    """Index of the centroid nearest to an array column; the lowest index wins a tie.

    Squared distances that agree to ``decimals`` tie; without, only equal ones do.
    """

    def distance(centroid: Sequence[float]) -> Column:
        differences = (F.get(point, i) - F.lit(float(x)) for i, x in enumerate(centroid))
        total = sum((d * d for d in differences), F.lit(0.0))
        return total if decimals is None else F.round(total, decimals)

    distances = F.array(*map(distance, centroids))
    return (F.array_position(distances, F.array_min(distances)) - 1).cast("int")
