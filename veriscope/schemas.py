"""Declared schemas (no inference on untrusted input)."""

from pyspark.sql import types as T

AUTHOR = T.StructType([T.StructField("author", T.MapType(T.StringType(), T.StringType()), True)])

RAW_WORK = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("doi", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("publication_year", T.IntegerType(), True),
    T.StructField("abstract_inverted_index", T.MapType(T.StringType(), T.ArrayType(T.IntegerType())), True),
    T.StructField("authorships", T.ArrayType(AUTHOR), True),
])

WORK = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("doi", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("publication_year", T.IntegerType(), True),
    T.StructField("abstract", T.StringType(), True),
    T.StructField("authors", T.StringType(), True),
])

PAPER = T.StructType([
    T.StructField("doi", T.StringType(), True),
    T.StructField("paperId", T.StringType(), True),
    T.StructField("abstract", T.StringType(), True),
    T.StructField("citationCount", T.IntegerType(), True),
    T.StructField("influentialCitationCount", T.IntegerType(), True),
])

META = T.StructType([
    T.StructField("title", T.StringType(), True),
    T.StructField("publication_year", T.IntegerType(), True),
    T.StructField("authors", T.StringType(), True),
    T.StructField("doi", T.StringType(), True),
    T.StructField("open_alex_id", T.StringType(), True),
])

CORPUS_RECORD = "doc_id long, title string, abstract array<string>"
CLAIM_RECORD = "id long, claim string, doc_ids array<long>"
