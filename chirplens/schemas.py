"""Fixed schemas.  Readers and writers use these; nothing is inferred."""

from pyspark.sql import types as T

TWEET = T.StructType(
    [
        T.StructField("tid", T.LongType()),
        T.StructField("user", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("urls", T.ArrayType(T.StringType())),
    ]
)

# One record of the timeline feed, one JSON object per line.
RAW = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("user", T.StructType([T.StructField("screen_name", T.StringType())])),
        T.StructField("created_at", T.StringType()),
        T.StructField(
            "urls", T.ArrayType(T.StructType([T.StructField("expanded_url", T.StringType())]))
        ),
    ]
)

WORD_COUNTS = T.StructType(
    [
        T.StructField("word", T.StringType()),
        T.StructField("percent", T.DoubleType()),
        T.StructField("ts", T.TimestampNTZType()),
    ]
)

URLS = T.StructType(
    [
        T.StructField("url", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
    ]
)

WORD_COOCCUR = T.StructType(
    [
        T.StructField("w1", T.StringType()),
        T.StructField("w2", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("log_weight", T.DoubleType()),
        T.StructField("ts", T.TimestampNTZType()),
    ]
)

RESULT_TABLES = {"word_counts": WORD_COUNTS, "urls": URLS, "word_cooccur": WORD_COOCCUR}
