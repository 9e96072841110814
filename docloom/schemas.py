"""Declared schemas; nothing is inferred."""

from pyspark.sql import types as T

METADATA = T.StructType([
    T.StructField("celex_number", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("identifier", T.StringType()),
    T.StructField("eli_uri", T.StringType()),
    T.StructField("html_url", T.StringType()),
    T.StructField("pdf_url", T.StringType()),
    T.StructField("dates", T.MapType(T.StringType(), T.StringType())),
    T.StructField("authors", T.ArrayType(T.StringType())),
    T.StructField("responsible_body", T.StringType()),
    T.StructField("form", T.StringType()),
    T.StructField("eurovoc_descriptors", T.ArrayType(T.StringType())),
    T.StructField("subject_matters", T.ArrayType(T.StringType())),
    T.StructField("directory_codes", T.ArrayType(T.StringType())),
    T.StructField("directory_descriptions", T.ArrayType(T.StringType())),
])
DOCUMENT = T.StructType([
    T.StructField("metadata", METADATA),
    T.StructField("content", T.StringType()),
])
PROCESSED_DOCUMENT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("celex_number", T.StringType()),
    T.StructField("html_url", T.StringType()),
    T.StructField("total_words", T.LongType()),
    T.StructField("summary", T.StringType()),
    T.StructField("summary_word_count", T.LongType()),
    T.StructField("compression_ratio", T.DoubleType()),
    T.StructField("tier", T.IntegerType()),
])
SECTION = T.StructType([
    T.StructField("document_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("section_type", T.StringType()),
    T.StructField("section_order", T.LongType()),
    T.StructField("word_count", T.LongType()),
])
EVENT = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
