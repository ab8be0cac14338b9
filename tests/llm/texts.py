"""Tables made from texts."""


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
