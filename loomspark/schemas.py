"""Declared schemas of the row kinds the engine reads; nothing is inferred from the first rows."""

from pyspark.sql import types as T

TURN = T.StructType([T.StructField("role", T.StringType()), T.StructField("content", T.StringType())])
RAW_TURN = T.StructType([T.StructField("from", T.StringType()), T.StructField("value", T.StringType())])
IMAGE = T.StructType([T.StructField("bytes", T.BinaryType()), T.StructField("path", T.StringType())])

RAW_TRAJECTORY = T.StructType([T.StructField("images", T.ArrayType(IMAGE)), T.StructField("conversations", T.ArrayType(RAW_TURN))])
TRAINING_ROW = T.StructType(
    [T.StructField("messages", T.ArrayType(TURN)), T.StructField("images", T.ArrayType(T.StringType())), T.StructField("game", T.StringType()), T.StructField("channel", T.StringType())]
)
MULTIMODAL_ROW = T.StructType(
    [T.StructField("messages", T.ArrayType(TURN)), T.StructField("images", T.ArrayType(IMAGE)), T.StructField("objects", T.StringType()), T.StructField("data_source", T.StringType())]
)
CATALOG = T.StructType(
    [T.StructField("datasets", T.ArrayType(T.StructType([T.StructField("canonical_name", T.StringType()), T.StructField("stats", T.StructType([T.StructField("output_rows", T.LongType())]))])))]
)
PLAN_DATASET = T.StructType(
    [T.StructField("ord", T.IntegerType()), T.StructField("dataset", T.StringType()), T.StructField("size", T.LongType()), T.StructField("passes", T.StringType()), T.StructField("target", T.LongType()),
     T.StructField("full_passes", T.LongType()), T.StructField("fractional", T.LongType()), T.StructField("a_inv", T.LongType()), T.StructField("b", T.LongType())]
)
PLAN_QUOTA = T.StructType([T.StructField("phase", T.IntegerType()), T.StructField("dataset", T.StringType()), T.StructField("start", T.LongType()), T.StructField("count", T.LongType())])
