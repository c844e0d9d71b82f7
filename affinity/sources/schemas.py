"""Default column names and the schemas of the metric tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Default column names (every operator takes them as arguments).
DATE = "t_dat"
PRICE = "price"
CUSTOMER_ID = "customer_id"
ARTICLE_ID = "article_id"
CUSTOMER = "customer_int"
ARTICLE = "article_int"
WEIGHT = "weight"

BATCH_METRICS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("epoch_number", T.IntegerType()),
        T.StructField("batch_number", T.IntegerType()),
        T.StructField("pred_loss", T.DoubleType()),
        T.StructField("penalty_loss", T.DoubleType()),
        T.StructField("loss", T.DoubleType()),
    ]
)

EPOCH_METRICS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("epoch_number", T.IntegerType()),
        T.StructField("train_pred_loss", T.DoubleType()),
        T.StructField("val_pred_loss", T.DoubleType()),
    ]
)
