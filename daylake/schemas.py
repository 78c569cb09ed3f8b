"""Declared schemas of the columns the jobs name."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.StructType([T.StructField("value", T.StringType()), T.StructField("currency", T.StringType())])

# Field names of the nested documents.
GARNISH = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("sequence", T.LongType()),
        T.StructField("externalId", T.StringType()),
        T.StructField("integrationId", T.StringType()),
        T.StructField("categoryId", T.StringType()),
        T.StructField("categoryName", T.StringType()),
        T.StructField("addition", MONEY),
        T.StructField("discount", MONEY),
        T.StructField("unitPrice", MONEY),
        T.StructField("totalValue", MONEY),
    ]
)

ITEM = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("quantity", T.DoubleType()),
        T.StructField("externalId", T.StringType()),
        T.StructField("integrationId", T.StringType()),
        T.StructField("customerNote", T.StringType()),
        T.StructField("addition", MONEY),
        T.StructField("discount", MONEY),
        T.StructField("unitPrice", MONEY),
        T.StructField("totalValue", MONEY),
        T.StructField("totalAddition", MONEY),
        T.StructField("totalDiscount", MONEY),
        T.StructField("garnishItems", T.ArrayType(GARNISH)),
    ]
)

ITEMS = T.ArrayType(ITEM)
