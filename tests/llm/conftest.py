import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def edge_texts():
    """NULL, empty, white space, one word, repeated, very long, other scripts, controls."""
    return [
        None,
        "",
        " ",
        "\n\t \n",
        "word",
        "the same text twice",
        "the same text twice",
        "two  spaces \n and\u00a0more ",
        "It's 12,000 o'clock <|endoftext|> isn't it?",
        "naïve façade 漢字かな 🎉🎉 Ω ɐ \x1c\x1d ²½",
        "longword" * 4000,
        "many words " * 5000,
    ]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The same with a repeated id, a NULL id, and extra columns named like results."""
    rows = [(i, t, "en", float(i), "x", [i]) for i, t in enumerate(edge_texts())]
    rows += [(5, "the same text twice", "en", 5.0, "x", [5]), (4, "another text of one id", None, 0.0, None, None), (None, "no id", "en", None, "", [])]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double, found string, ids array<int>")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
