import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, schema="doc_id long, text string, lang string, source string"):
        width = len(schema.split(","))
        return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema).repartition(3)

    return make
