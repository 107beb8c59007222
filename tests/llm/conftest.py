import pytest

#: names that the operators use inside, to clash with
CLASHES = ["key", "c", "n", "h", "sig", "shard", "copies", "score", "component", "hash", "node", "rank", "chosen_id", "bad_id"]


@pytest.fixture
def docs(spark):
    """docs((id, text), ...) or docs((id, text, lang), ...), with columns of clashing names beside."""

    def made(*rows, clash=True):
        full = [(i, t, *(rest or (None,))) for i, t, *rest in rows]
        df = spark.createDataFrame(full, "doc_id long, text string, lang string")
        for name in CLASHES if clash else ():
            df = df.selectExpr("*", f"'x' AS {name}")
        return df.selectExpr("*", "'s' AS source", "cast(length(text) as long) AS n_chars")

    return made
