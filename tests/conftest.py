from __future__ import annotations

import pytest

from veritally.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def many_ranges(spark):
    """Keep small shuffles in several partitions, as large ones would be."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield spark
    spark.conf.set(name, before)


@pytest.fixture
def scored(spark):
    """Builds a scored frame from (label, probability) pairs."""

    def build(pairs):
        rows = [(i, y, p) for i, (y, p) in enumerate(pairs)]
        return spark.createDataFrame(rows, "doc_id bigint, labels int, toxic_prob double")

    return build


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]
