"""Arrivals are written by as many tasks as the source has partitions."""

import glob

import pytest

from clickweir import queries
from conftest import SF_SMALL


@pytest.mark.parametrize("name", ["q_stream_increments", "q_stream_unordered"])
def test_arrivals_keep_the_partitions_of_the_source(spark, monkeypatch, name):
    src, start, files = queries._src, queries.start_stream, []

    def counted(session, landing, *args, **options):
        files.append(len(glob.glob(f"{landing.removeprefix('file:')}/part-*")))
        return start(session, landing, *args, **options)

    monkeypatch.setattr(queries, "_src", lambda session, sf: src(session, sf).repartition(3))
    monkeypatch.setattr(queries, "start_stream", counted)
    getattr(queries, name)(spark, SF_SMALL).count()
    assert files == [3, 6]
