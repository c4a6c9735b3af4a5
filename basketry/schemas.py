"""Fixed schemas of the tables at rest."""

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import types as T


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# One type for all amounts, wide enough to keep them as written; sums stay exact.
AMOUNT = T.DecimalType(28, 10)

TICKETS = _struct(
    customerid=T.LongType(),
    storeid=T.LongType(),
    cardtype=T.StringType(),
    datekey=T.StringType(),
    ticketid=T.LongType(),
    productid=T.LongType(),
    extendedamount=AMOUNT,
    originalamount=AMOUNT,
    totaldiscount=AMOUNT,
    quantity=T.DoubleType(),
)

CUSTOMERS = _struct(customerid=T.LongType(), age=T.IntegerType(), gender=T.StringType())

STORES = _struct(storeid=T.LongType(), city=T.StringType())

PRODUCTS = _struct(
    productid=T.LongType(),
    merchandisegroup=T.StringType(),
    merchandisefamily=T.StringType(),
    vatdescription=T.StringType(),
    article=T.StringType(),
)

CLASSIFICATION = _struct(
    merchandisefamily=T.StringType(),
    healthy=T.StringType(),
    unhealthy=T.StringType(),
)

PREDICTIONS = _struct(
    customerid=T.LongType(),
    recency=T.IntegerType(),
    frequency=T.LongType(),
    monetary=T.DoubleType(),
    r_quartile=T.IntegerType(),
    f_quartile=T.IntegerType(),
    m_quartile=T.IntegerType(),
    rfm_score=T.StringType(),
    features=VectorUDT(),
    scaled_features=VectorUDT(),
    prediction=T.IntegerType(),
    segmento=T.StringType(),
    prediction_label=T.StringType(),
)

THRESHOLDS = _struct(
    metric=T.StringType(),
    q1=T.DoubleType(),
    q2=T.DoubleType(),
    q3=T.DoubleType(),
)

BOUNDS = _struct(metric=T.StringType(), bound=T.DoubleType())

CENTROIDS = _struct(
    prediction=T.IntegerType(),
    r=T.DoubleType(),
    f=T.DoubleType(),
    m=T.DoubleType(),
)
