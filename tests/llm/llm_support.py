"""Inputs that the tests of the training-data operators share."""

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "many words of one long text, and then some more. " * 4_000


def docs(spark, texts, first=0):
    return spark.createDataFrame([(first + k, t, "en", "a", len(t or "")) for k, t in enumerate(texts)], SCHEMA)
