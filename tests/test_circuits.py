"""Circuits fitted to many spectra at once."""

import time

import numpy as np
import pytest

from voltplane.operators import numeric
from voltplane.plans import model_queries


def spectra(n):
    rng = np.random.default_rng(3)
    return [model_queries.known_spectrum(i, rng.normal(size=64)) for i in range(n)]


def test_same_circuits_as_one_by_one():
    some = spectra(40)
    f, z = some[0][0], np.array([z for _, z in some])
    # a second arc that is there, a gap and a zero
    z[:6] += 0.02 / (1 + (2j * np.pi * f * 1.0) ** 0.8)
    z[7, 3], z[8, 5] = np.nan, 0
    # a block of 16 ends within and after the odd ones
    for got, row in zip(numeric.select_circuits(f, z, block=16), z, strict=True):
        with np.errstate(all="ignore"):
            arcs, p, sd = numeric.select_circuit(f, row)
        assert got[0] == arcs
        assert got[1][0] == pytest.approx(p[0], rel=1e-5, nan_ok=True) and got[2][0] == pytest.approx(sd[0], rel=1e-2, nan_ok=True)
    assert {arcs for arcs, _, _ in numeric.select_circuits(f, z[:6])} == {2}


def test_many_take_a_part_of_the_time():
    some = spectra(256)
    f, z = some[0][0], np.array([z for _, z in some])
    start = time.process_time()
    for row in z[:16]:
        numeric.select_circuit(f, row)
    alone, start = (time.process_time() - start) / 16, time.process_time()
    assert len(numeric.select_circuits(f, z)) == 256
    assert (time.process_time() - start) / 256 < alone / 4


def test_tasks_follow_the_vectors(spark, monkeypatch):
    """Not only the cores that are there when the query is planned."""
    vectors = spark.range(10_000).selectExpr("id AS vec_id", "array(1.0D) AS w")
    monkeypatch.setattr(model_queries, "TASK", 1000, raising=False)
    out = model_queries.per_vector(vectors, lambda i, w: [(i,)], "vec_id long")
    assert out.rdd.getNumPartitions() == 10 and out.distinct().count() == 10_000
