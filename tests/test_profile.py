import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from rillweave.config import SkewPolicy
from rillweave.operators import profile


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(share=2)])
@pytest.mark.parametrize("accuracy", [20, 20_000])
def test_salary_distribution_is_exact(spark, policy, accuracy):
    rng = random.Random(4)
    groups = {"A": [round(rng.lognormvariate(10, 1), 2) for _ in range(3001)], "B": [5.0] * 700 + [7.0] * 700, "C": [9.5], "D": [1.0, 2.0]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("A", None), (None, 3.0), ("E", None)]
    df = spark.createDataFrame(rows, "employment_type string, salary_usd_annual double").repartition(6)
    out = {r.employment_type: r for r in profile.salary_distribution(df, accuracy=accuracy, policy=policy).collect()}
    assert set(out) == set(groups)
    for g, vs in groups.items():
        assert (out[g].employees, out[g].min_salary, out[g].median_salary, out[g].max_salary) == (len(vs), min(vs), float(np.median(vs)), max(vs))
    density = profile.salary_density(df, policy=policy).collect()
    for g, vs in groups.items():
        counts = {r.bin: r.employees for r in density if r.employment_type == g}
        if len(set(vs)) > 1:
            expected = np.histogram(vs, bins=100)[0]
            assert [counts.get(i, 0) for i in range(100)] == expected.tolist()
        else:
            assert counts == {0: len(vs)}


@pytest.mark.parametrize("dates", [
    [datetime(2000, 1, 1) + timedelta(days=37 * i, hours=9 * (i % 2)) for i in range(300)] + [datetime(2030, 1, 1), datetime(1950, 1, 1)],
    [datetime(2020, 5, 5)] * 3,
])
def test_tenure_histogram_is_numpys(spark, dates):
    as_of = datetime(2026, 12, 3)
    df = spark.createDataFrame([(d,) for d in dates] + [(None,)], "hire_date timestamp_ntz")
    years = [(as_of - d).days / 365.25 for d in dates]
    counts, edges = np.histogram([y for y in years if 0 <= y <= 50], bins=25)
    rows = profile.tenure_histogram(df, "2026-12-03").orderBy("bin").collect()
    assert [r.employees for r in rows] == counts.tolist()
    assert np.allclose([r.from_years for r in rows], edges[:-1]) and np.allclose([r.to_years for r in rows], edges[1:])


def test_tenure_of_nobody(spark):
    rows = profile.tenure_histogram(spark.createDataFrame([], "hire_date timestamp_ntz"), "2026-12-03").collect()
    assert [r.employees for r in rows] == [0] * 25


def test_counts_and_rates(spark):
    rows = [("A", "p", "x"), ("A", None, "x"), ("A", None, None), ("B", None, "y"), (None, "p", "y"), ("C", "p", "z")]
    df = spark.createDataFrame(rows, "department string, plan_type string, country string")
    assert [tuple(r) for r in profile.headcount_by_department(df).collect()] == [("A", 3), ("B", 1), ("C", 1)]
    assert [tuple(r) for r in profile.headcount_by_country(df).collect()] == [("x", 2), ("y", 2), ("z", 1)]
    assert [tuple(r) for r in profile.enrollment_rate(df).collect()] == [("C", 1, 1, 100.0), ("A", 1, 3, 33.3)]
    assert len(profile.top_counts(df, "country", 1).collect()) == 1
