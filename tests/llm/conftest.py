import pytest

WORD_CASES = [
    None,
    "",
    " ",
    "\n\n",
    "one",
    "One two THREE",
    "a b c d e f g h i j k l",
    "same same same same same same same same",
    "ÄÖÜ ñandú\tçedille line no-break",
    "line\nline\nother\nline",
    "x" * 5000,
    " ".join(f"w{i}" for i in range(3000)),
]


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows and ids, an extra column with a clashing name."""
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 3}" if i % 4 else None, None if t is None else len(t)) for i, t in enumerate(WORD_CASES)]
    rows += [rows[5], rows[6], (None, "null id with some words in it", "en", "src0", 29), (7, "an id that is used twice", "en", "src1", 24)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.selectExpr("*", "'x' as size", "1 as n_words", "2 as score", "3 as h", "'y' as label")


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")
