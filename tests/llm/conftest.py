import pytest

#: Column names of the operators themselves, which a table may also use for something else.
CLASHES = "size long, point long, key string, hi long, row string, score double, spans string, token long, component long, template string, lang_pred string, n_bytes string, kept string, text_ string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and columns with clashing names."""
    long_ = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog again", "en", "a"), (2, "the QUICK brown fox jumps over the lazy dog again", "en", "b"),
        (3, None, "en", "a"), (4, "", "en", None), (5, " \t\n ", None, "a"), (6, "12345 67890 !!", "en", "b"), (7, long_, "en", "a"),
        (8, long_ + " end", None, None), (9, "Der schnelle braune Fuchs springt über den faulen Hund", "de", "a"),
        (9, "Der schnelle braune Fuchs springt über den faulen Hund", "de", "a"), (None, "one two three", "en", "a"), (None, "one two three", "en", "a"),
        (12, "One two three", None, None), (13, "x" * 50_000, None, "c"), (14, "\u0000 á 🙂 <|endoftext|> b", "en", "c"), (None, None, None, None),
        (15, "Ein Hund und ein Fuchs und der Wald", "de", "b"), (16, "a dog and a fox and the wood", "en", "b"),
    ]
    names = [x.split()[0] for x in CLASHES.split(", ")]
    wide = [(*r, None if r[1] is None else len(r[1]), *([None] * len(names))) for r in rows]
    return spark.createDataFrame(wide, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHES}")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
