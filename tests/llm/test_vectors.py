"""Links, components and kept rows of vectors against all cosines; the index's bounds."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import vectors

from llm_cases import CLASHES


def brute(rows, cosine):
    def fine(v):
        return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)

    known = [i for i, (_, v, label) in enumerate(rows) if label is not None and fine(v)]
    unit = {i: np.array(rows[i][1], float) / np.abs(rows[i][1]).max() for i in known}
    unit = {i: u / np.sqrt((u * u).sum()) for i, u in unit.items()}
    near = {i: [j for j in known if j != i and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= cosine - 1e-12] for i in known}
    out = Counter()
    for i, (who, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out[(who, len(near.get(i, [])), least, who == least)] += 1
    return out


def cloud(seed, n, size, copies, noise):
    r = np.random.default_rng(seed)
    base = r.normal(size=(n, size))
    near = [base[r.integers(n)] + r.normal(size=size) * noise for _ in range(copies)]
    return [[float(np.float32(x)) for x in v] for v in [*base, *near]]


def frame(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    return df.select("*", *[F.lit("clash").alias(c) for c in [*CLASHES, "v", "list", "probes", "least", "copies", "component"]]).repartition(4)


def check(got, rows, cosine=vectors.COSINE):
    assert Counter(tuple(x) for x in got.select("vec_id", "n_links", "component_id", "kept").collect()) == brute(rows, cosine)


@pytest.mark.parametrize("options", [{}, {"block": 7, "askers": 5}, {"lists": 40, "broadcast_bytes": 0}, {"sample": 30, "codes": 3, "subspaces": 5}])
def test_against_all_cosines(spark, options):
    vs = cloud(1, 90, 16, 150, 0.24)
    rows = [(i * 3 % 701, v, i % 4 and i % 3) for i, v in enumerate(vs)]
    rows += [(1000 + i, vs[3], 1) for i in range(30)]  # equal ones
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [1.0, None] * 8, 1), (2004, [float("nan")] + vs[3][1:], 1), (2005, [float("inf")] * 16, 1)]
    rows += [(2010, vs[3], None), (None, vs[3], 1), (None, [9.0, 1.0], 2), (None, [9.0, 1.0], 2), (2011, vs[3], 1), (2011, vs[3], 1), (2012, vs[3][:8], 1)]
    rows += [(2020, [3e30] * 16, 2), (2021, [1e-30] * 16, 2), (2022, [-1.0] * 16, 2), (2030, [0.0, -0.0, 1.0] + [0.0] * 13, 2), (2031, [-0.0, 0.0, 2.0] + [0.0] * 13, 2)]
    got = vectors.near_copies(frame(spark, rows), **options)
    check(got, rows)
    assert got.where("n_links > 1").count() > 60 and got.where("NOT kept").count() > 60


def test_query(spark):
    rows = [(i, v, i % 2) for i, v in enumerate(cloud(2, 200, 64, 120, 0.2))] + [(10**12 + i, v, 1) for i, v in enumerate(cloud(3, 1, 64, 80, 0.12))]
    check(vectors.query(frame(spark, rows)), rows)
    assert vectors.query(frame(spark, rows).limit(0)).count() == 0
    one = [(1, [0.5, 0.5], 1), (2, [0.6, 0.5], 1)]
    check(vectors.near_copies(frame(spark, one, "double"), cosine=1.0), one, 1.0)


def test_no_neighbour_is_ruled_out():
    """Neither lists nor codes rule out a vector within reach."""
    vs = np.array(cloud(4, 300, 32, 600, 0.1))
    _, _, unit = vectors.units(vs)
    index = vectors.Index(unit[:200], 12, 4, 16)
    own, codes, error, far = index.place(unit)
    reach = math.sqrt(2 - 2 * 0.93)
    pairs = probed = 0
    for i in range(len(unit)):
        probes = set(index.probes(far[i], own[i], reach).tolist())
        near = np.flatnonzero(np.sqrt(((unit - unit[i]) ** 2).sum(1)) <= reach)
        assert all(own[j] in probes for j in near if own[j] >= own[i])
        for c in set(own[near].tolist()):
            there = near[own[near] == c]
            assert (index.distances(unit[i:i + 1], c, codes[there])[0] <= reach + error[there] + 1e-9).all()
        pairs, probed = pairs + len(near), probed + len(probes)
    assert pairs > 2000 and probed < 6 * len(unit)
    assert np.allclose(index.spoken(codes) + index.centres[own], unit, atol=error.max())
