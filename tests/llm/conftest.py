import pytest


@pytest.fixture()
def docs(spark):
    """A table of documents from (doc_id, text) or longer rows, with a clashing extra column."""

    def make(rows):
        full = [(*row, *("en", "src0")[len(row) - 2 :], "x")[:5] for row in rows]
        return spark.createDataFrame(
            full, "doc_id bigint, text string, lang string, source string, n bigint".replace(
                "n bigint", "recipe string"
            )
        )

    return make
