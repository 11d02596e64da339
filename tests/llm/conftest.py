import pytest

from tests.llm import odd


@pytest.fixture(scope="session")
def odd_docs(spark):
    return spark.createDataFrame(odd.rows(), odd.SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], odd.SCHEMA)


@pytest.fixture(scope="session")
def sf_dir(spark, tmp_path_factory):
    """A tables folder whose documents, labels and benchmark are the odd ones."""
    d = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame(odd.rows(), odd.SCHEMA).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(odd.labels(), "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(odd.items(), "item_id long, text string, score double").write.parquet(f"{d}/benchmark.parquet")
    return d
