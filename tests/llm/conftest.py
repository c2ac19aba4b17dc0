import pytest


@pytest.fixture(scope="session")
def docs_frame(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
