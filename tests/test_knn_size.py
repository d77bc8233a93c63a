"""What the nearest-neighbour search sends to its tasks, and how it packs vectors."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from posttags.operators import neighbors
from test_knn import brute, ranked

SCHEMA = "id bigint, features array<double>"


def test_rows_sent_do_not_grow_with_blocks(spark, monkeypatch):
    """However small the blocks are, a post goes to each part of the other side once."""
    sent, apply = [], PandasCogroupedOps.applyInArrow

    def counted(self, *args):
        sent.extend(side._df.count() for side in (self._gd1, self._gd2))
        return apply(self, *args)

    monkeypatch.setattr(PandasCogroupedOps, "applyInArrow", counted)
    values = np.random.default_rng(3).normal(size=(300, 6)).tolist()
    rows = list(enumerate(values))
    train, test = (spark.createDataFrame(some, SCHEMA) for some in (rows[:200], rows[200:]))
    found = ranked(neighbors.nearest(test, train, 4, pivots=5, block_rows=1))
    assert found == brute(rows[200:], rows[:200], 4)
    assert sent[0] <= 100 * neighbors.TILES and sent[1] <= 200 * neighbors.CHUNKS


@pytest.mark.parametrize("tile_rows, tile_bytes", [(10, 32 << 20), (1024, 400)])
def test_many_parts(spark, monkeypatch, tile_rows, tile_bytes):
    monkeypatch.setattr(neighbors, "TILE_ROWS", tile_rows)
    monkeypatch.setattr(neighbors, "TILE_BYTES", tile_bytes)
    rng = np.random.default_rng(5)
    values = rng.poisson(0.3, size=(150, 20)) * rng.choice([1.0, 0.5, 16.0, 1e-20], size=(150, 1))
    rows = list(enumerate(values.tolist()))
    train, test = (spark.createDataFrame(some, SCHEMA) for some in (rows[:120], rows[120:]))
    assert ranked(neighbors.nearest(test, train, 6, pivots=7)) == brute(rows[120:], rows[:120], 6)


def test_packed_vectors_come_back():
    block = np.array([[0, 0, 0, 0], [1.5, 0, 0, 0], [1, 2, 3, 4], [0, 0, 0, -2], [-0.0, 0, 0, 0], [0, 9, 8, 7]], float)
    at, values = neighbors._packed(block)
    assert at[0] == at[4] and values[0] == values[4]
    for some in ([0, 1, 2, 3, 4, 5], [5, 2, 0], [3]):
        vectors = neighbors._Vectors(pa.chunked_array([at]), values, 4)
        assert (vectors.rows(np.array(some)) == block[some]).all()
    assert (neighbors._Vectors(at.slice(2, 3), values.slice(2, 3), 4).rows(np.arange(3)) == block[2:5]).all()


def test_large_parts_spare_copies(spark):
    """Each part of one side gets a copy of the other side, so 100 MB are not cut further."""
    big = spark.range(100).selectExpr("cast(repeat('x', 1 << 20) as binary) as values", "cast('' as binary) as at")
    assert neighbors._n_parts(big, 1) == 1
    assert neighbors._n_parts(big.union(big), 1) == 2
