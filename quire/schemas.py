
from pyspark.sql import types as T

IDS = T.ArrayType(T.IntegerType(), containsNull=False)

LINES = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("line_no", T.LongType()),
    T.StructField("text", T.StringType()),
])

TOKENS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("input_ids", IDS),
    T.StructField("attention_mask", IDS),
])

BLOCKS = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("block_id", T.LongType()),
    T.StructField("input_ids", IDS),
    T.StructField("attention_mask", IDS),
    T.StructField("labels", IDS),
])

BATCHES = T.StructType([
    T.StructField("batch_id", T.LongType()),
    T.StructField("rows", T.IntegerType()),
    T.StructField("input_ids", T.ArrayType(IDS)),
    T.StructField("attention_mask", T.ArrayType(IDS)),
    T.StructField("labels", T.ArrayType(IDS)),
])

PREDICTIONS = T.StructType([
    T.StructField("idx", T.LongType()),
    T.StructField("Input", T.StringType()),
    T.StructField("Output", T.StringType()),
])

METRICS = T.StructType([
    T.StructField("phase", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])

VOCAB = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("piece", T.StringType()),
    T.StructField("score", T.DoubleType()),
])

MANIFEST = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("block_size", T.IntegerType()),
    T.StructField("tokenizer_fp", T.StringType()),
    T.StructField("content_fp", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("rows", T.LongType()),
])


def same_schema(a: T.StructType, b: T.StructType) -> bool:
    """Column names and types equal, nullability ignored."""
    def norm(s):
        return [(f.name, f.dataType.simpleString()) for f in s.fields]
    return norm(a) == norm(b)
