import collections
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql.functions import spark_partition_id
from test_functions import _lcs

from rillweave.config import IntegrationConfig, SkewPolicy
from rillweave.operators import fuzzy
from rillweave.operators.fuzzy import (
    _signatures,
    cell_links,
    flag_probable,
    fuzzy_pairs,
    name_cells,
    review_links,
    review_records,
    similar_cells,
)
from rillweave.operators.interval import interval_partners

SCHEMA = "employee_id string, first_name string, last_name string, hire_date timestamp_ntz, source_systems string"
TINY = SkewPolicy(share=8, scatter=4, block_rows=2)


def people(n, seed, letters="abn", days=200):
    rng = random.Random(seed)

    def word(low, high):
        return "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))

    pool = [(word(3, 9), word(4, 12)) for _ in range(max(6, n // 6))]
    rows = []
    for i in range(n):
        first, last = rng.choice(pool)
        if rng.random() < 0.5:
            name = list(last)
            at = rng.randrange(len(name))
            name[at : at + 1] = rng.choice([[], [rng.choice(letters)], [name[at], rng.choice(letters)]])
            last = "".join(name)
        if rng.random() < 0.2:
            first, last = last, first
        date = datetime(2019, 12, 1) + timedelta(days=rng.randrange(days), hours=rng.choice([0, 0, 9]))
        if rng.random() < 0.3:
            date = datetime(2020, 1, 1)
        rows.append((f"GT-{i:06d}", first, last or None, None if rng.random() < 0.05 else date, "payroll"))
    return rows


def brute(rows, threshold, days):
    """All pairs, straight from the definition."""
    known = [r for r in rows if r[3]]
    out = set()
    for i, a in enumerate(known):
        for b in known[i + 1 :]:
            if abs(a[3] - b[3]) > timedelta(days=days):
                continue
            x, y = (" ".join(sorted(f"{r[1] or ''} {r[2] or ''}".lower().split())) for r in (a, b))
            total = len(x) + len(y)
            if abs(len(x) - len(y)) * 100 > (100 - threshold) * total:
                continue
            distance = total - 2 * _lcs(x, y)
            if distance * 100 <= (100 - threshold) * total:
                p, q = sorted((a, b), key=lambda r: (r[3], r[0]))
                score = (1.0 - distance / max(total, 1)) * 100.0
                out.add((p[0], q[0], score, (q[3] - p[3]).days))
    return out


@pytest.mark.parametrize("threshold,days,seed,policy", [
    (88, 30, 1, SkewPolicy()), (88, 30, 2, TINY), (75, 10, 3, TINY), (60, 7, 4, SkewPolicy()), (30, 7, 6, TINY), (95, 30, 5, TINY),
])
def test_pairs_and_flags_equal_brute_force(spark, threshold, days, seed, policy):
    rows = people(150, seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    cells = name_cells(df, days).cache()
    similar = similar_cells(cells, threshold, policy).cache()
    expected = brute(rows, threshold, days)
    found = fuzzy_pairs(df, cells, cell_links(cells, similar), days, policy).collect()
    assert len(found) == len(expected)
    assert {(r.record_1_id, r.record_2_id, r.similarity_score, r.hire_date_diff_days) for r in found} == expected
    flagged = {r.employee_id for r in flag_probable(df, cells, similar, days, policy).where("probable_match_flag").collect()}
    assert flagged == {i for p in expected for i in p[:2]}
    assert flag_probable(df, cells, similar, days, policy).count() == len(rows)


def _places(rows, days):
    """Cell (bucket, name) of each record with a date."""
    width, start = timedelta(days=days), datetime(1970, 1, 1)
    return {r[0]: ((r[3] - start) // width, " ".join(sorted(f"{r[1] or ''} {r[2] or ''}".lower().split()))) for r in rows if r[3]}


@pytest.mark.parametrize("threshold,days,seed", [(88, 30, 12), (75, 5, 13)])
def test_links_and_records_sum_up_the_pairs(spark, threshold, days, seed):
    rng = random.Random(seed)
    # Instants of all sorts, so that partners in adjacent buckets are counted within slices too.
    rows = [(*r[:3], r[3] and r[3] + timedelta(seconds=rng.choice([0, 0, 1, 7200, 40000])), r[4]) for r in people(200, seed, days=40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    cells = name_cells(df, days).cache()
    links = review_links(df, cells, similar_cells(cells, threshold), days).cache()
    place, expected = _places(rows, days), collections.defaultdict(lambda: [0, None])
    for a, b, score, _ in brute(rows, threshold, days):
        link = expected[tuple(sorted((place[a], place[b])))]
        link[0] += 1
        link[1] = score
    sizes = collections.Counter(place.values())
    got = {((r.bucket_1, r.name_1), (r.bucket_2, r.name_2)): (r.n_pairs, r.similarity_score, r.records_1, r.records_2) for r in links.collect()}
    assert got == {k: (n, score, sizes[k[0]], sizes[k[1]]) for k, (n, score) in expected.items()} and len(got) == links.count()
    linked = {c for link in expected for c in link}
    found = [((r.bucket, r.name), r.employee_id) for r in review_records(df, links, days).collect()]
    assert sorted(found) == sorted((c, i) for i, c in place.items() if c in linked)
    # The pairs of chosen links alone.
    chosen = links.where("n_pairs > 1")
    pairs = {(r.record_1_id, r.record_2_id) for r in fuzzy_pairs(df, cells, chosen, days).collect()}
    wanted = {k for k, (n, _) in expected.items() if n > 1}
    assert pairs == {p[:2] for p in brute(rows, threshold, days) if tuple(sorted((place[p[0]], place[p[1]]))) in wanted}


def test_signatures_of_a_name_are_few(spark):
    rng = random.Random(5)
    names = ["".join(rng.choices("abcdefgh", k=k)) for k in (3, 8, 20, 60, 120, 200)]
    cells = spark.createDataFrame([(0, x, 1, 0, 0) for x in names], "bucket int, key string, n long, min_t long, max_t long")
    count = {r.key: r["count"] for r in _signatures(cells, 88).groupBy("key").count().collect()}
    assert all(count[x] <= len(x) for x in names) and count[names[-1]] <= 0.7 * 200


@pytest.mark.parametrize("policy", [SkewPolicy(), TINY])
def test_longer_names_lose_nothing(spark, policy):
    rng = random.Random(9)
    rows = []
    for i in range(120):
        base = list("maximiliana alexandrina von hohenzollern " * (1 + 4 * (i % 4 == 1)) if i % 2 else "li wu")
        for _ in range(rng.randrange(6 + 20 * (len(base) > 99))):
            at = rng.randrange(len(base))
            base[at : at + 1] = rng.choice([[], [rng.choice("aeiou")], [base[at], rng.choice("aeiou")]])
        rows.append((f"GT-{i:06d}", "".join(base), None, datetime(2020, 1, 1), "payroll"))
    df = spark.createDataFrame(rows, SCHEMA)
    cells = name_cells(df, 30).cache()
    found = fuzzy_pairs(df, cells, cell_links(cells, similar_cells(cells, 88, policy)), 30, policy)
    assert {(r.record_1_id, r.record_2_id) for r in found.collect()} == {p[:2] for p in brute(rows, 88, 30)}


def test_tasks_follow_the_pairs(spark, monkeypatch):
    """One crowded name and date: few records, many pairs, and no task has a large part of them."""
    monkeypatch.setattr(fuzzy, "PAIRS_PER_TASK", 1_000, raising=False)
    policy = SkewPolicy(block_rows=10)
    rows = [(f"GT-{i:06d}", "Ann", "Lee", datetime(2020, 1, 1 + i % 3), "payroll") for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    cells = name_cells(df, 30).cache()
    pairs = fuzzy_pairs(df, cells, cell_links(cells, similar_cells(cells, 88, policy)), 30, policy)
    shares = [r["count"] for r in pairs.groupBy(spark_partition_id()).count().collect()]
    assert sum(shares) == 200 * 199 // 2 and max(shares) <= 5_000
    assert len({(r.record_1_id, r.record_2_id) for r in pairs.collect()}) == 200 * 199 // 2


def test_name_display_and_missing_parts(spark):
    day = datetime(2020, 1, 1)
    rows = [("GT-000002", "o'neil", "SMITH-jones", day, "a"), ("GT-000001", "O'Neil", "Smith-Jones", day, "b"),
            ("GT-000003", None, None, day, "c"), ("GT-000004", None, None, day + timedelta(days=30), "d")]
    df = spark.createDataFrame(rows, SCHEMA)
    cells = name_cells(df, 30).cache()
    pairs = fuzzy_pairs(df, cells, cell_links(cells, similar_cells(cells, 88)), 30).orderBy("record_1_id").collect()
    assert [(r.record_1_id, r.record_2_id, r.record_1_name, r.record_1_source, r.hire_date_diff_days) for r in pairs] == [
        ("GT-000001", "GT-000002", "O'Neil Smith-Jones", "b", 0), ("GT-000003", "GT-000004", "", "c", 30),
    ]


def test_interval_partners(spark):
    rows = people(120, 11)
    df = spark.createDataFrame(rows, SCHEMA)
    known = [r[3] for r in rows if r[3]]
    expected = {(d, known.count(d), sum(abs(e - d) <= timedelta(days=30) for e in known) - 1) for d in set(known)}
    assert {tuple(r) for r in interval_partners(df, "hire_date", 30).collect()} == expected


def test_zero_stands_for_the_default_window_and_threshold():
    config = IntegrationConfig(date_window_days=0, fuzzy_threshold=0)
    assert (config.date_window_days, config.fuzzy_threshold) == (30, 88)


def test_partners_without_a_window_share_the_instant(spark):
    frame = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ'2020-01-01'), (TIMESTAMP_NTZ'2020-01-01'), (TIMESTAMP_NTZ'2020-01-02') AS v(d)")
    rows = interval_partners(frame, "d", 0).collect()
    assert len(rows) == 2 and sorted(r.partners for r in rows) == [0, 1]
