import pytest

from loadkit.llm.common import prepare


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    return prepare(spark)


@pytest.fixture
def docs(spark):
    """Documents with the given texts; ids from 0."""

    def make(texts, **more):
        rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return make
