import pytest

from signalwatch.session import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text[, source]) rows."""

    def make(*rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
