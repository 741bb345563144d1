import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"

#: Rows that every operator must take: NULLs in any column, empty, blank and long texts, repeats.
ODD = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omicron", "en", "x"),
    (2, None, None, None),
    (3, "", "en", "x"),
    (4, " \t\n\n ", "de", "y"),
    (5, "one two three four five six seven eight nine ten " * 4000, "en", "x"),
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omicron", "en", "x"),
    (6, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda omicron", "en", "y"),
    (None, "no id here at all", "en", "x"),
    (7, "naïve ÇA 中文 🙂\n" + "a shared line of twenty characters\n" * 2 + "tail", "fr", "é"),
    (8, "A SHARED line of twenty characters", "fr", "y"),
    (9, "  a shared line of twenty characters\t\nother", "fr", "y"),
]


@pytest.fixture(autouse=True)
def importable(spark):
    """Python workers import the package from the repository."""
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


@pytest.fixture(scope="session")
def odd(spark):
    """The odd rows, with extra columns that clash with the operators' own names."""
    rows = [(*r, "t", 5, "k") for r in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, words string, n long, `row.x` string")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
