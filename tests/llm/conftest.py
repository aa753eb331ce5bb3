import uuid

import pytest


@pytest.fixture
def made(spark, tmp_path):
    """Write rows as one table of a fresh folder and return the folder."""

    def make(name, rows, schema, folder=None):
        at = folder or str(tmp_path / uuid.uuid4().hex)
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
        return at

    return make
