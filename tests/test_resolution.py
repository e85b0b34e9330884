import random

import pytest

from rillweave.config import SOURCE_PRIORITY, SkewPolicy
from rillweave.operators.email_merge import email_groups, email_members, email_merge, loser_map, remap_reference
from rillweave.operators.ghosts import ghosts, payroll_only_ids
from rillweave.operators.skew import hot_keys, lookup
from rillweave.operators.survivorship import exact_merge, nullify_sentinels

TINY = SkewPolicy(share=8, scatter=4, block_rows=2)
RECORDS = "employee_id string, first_name string, base_salary double, email string, manager_id string, source_system string, _src int, _ord int"
SOURCES = list(SOURCE_PRIORITY)


def records(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        src = rng.randrange(4)
        key = "HOT" if rng.random() < 0.33 else rng.choice([None, "", "nan", *(f"K{k}" for k in range(60))])
        rows.append((key, rng.choice([None, "", "nan", "None", f"n{i}"]), rng.choice([None, float(i)]),
                     rng.choice([None, f"e{i}"]), None, SOURCES[src], src, i))
    return rows


def expected_merge(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (SOURCE_PRIORITY[r[5]], r[6], r[7])):
        if r[0] in (None, "", "nan", "None", "<NA>"):
            continue
        values, sources = out.setdefault(r[0], ([None] * 3, set()))
        for i, v in enumerate(r[1:4]):
            if values[i] is None and v not in (None, "", "nan", "None", "<NA>"):
                values[i] = v
        sources.add(r[5])
    return {(k, *v, ",".join(sorted(s)), "exact_id" if len(s) > 1 else "single_source") for k, (v, s) in out.items()}


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_exact_merge_does_not_depend_on_partitioning(spark, partitions):
    rows = records()
    random.Random(partitions).shuffle(rows)
    df = spark.createDataFrame(rows, RECORDS).repartition(partitions)
    merged = exact_merge(df).select("employee_id", "first_name", "base_salary", "email", "source_systems", "dedup_method")
    assert {tuple(r) for r in merged.collect()} == expected_merge(rows)


def test_exact_merge_combines_before_the_shuffle(spark):
    plan = exact_merge(spark.createDataFrame(records(), RECORDS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_min" in plan[plan.index("Exchange hashpartitioning"):]


def test_nullify_sentinels(spark):
    row = nullify_sentinels(spark.createDataFrame([("nan", "x", 1)], "a string, b string, c int")).first()
    assert tuple(row) == (None, "x", 1)


GOLDEN = "employee_id string, email string, manager_id string, source_systems string, dedup_method string"


def golden(n=300, seed=8):
    rng = random.Random(seed)
    provenance = ["globaltech_hris", "acquiredco_api", "payroll", "benefits,payroll", "globaltech_hris,payroll"]
    rows = []
    for i in range(n):
        email = rng.choice([None, " ", "no-at-sign", "no-at-sign", f"m{rng.randrange(40)}@x", f"u{i}@x", f"u{i}@x"])
        manager = rng.choice([None, "P0000", f"P{rng.randrange(n):04d}", "P0000"])
        rows.append((f"P{i:04d}", email, manager, rng.choice(provenance), "single_source"))
    return rows


def expected_email_merge(rows):
    def rank(r):
        return (min(SOURCE_PRIORITY[s] for s in r[3].split(",")), r[0])

    groups = {}
    for r in rows:
        if r[1] and r[1].strip():
            groups.setdefault(r[1], []).append(r)
    remap, winners = {}, {}
    for members in groups.values():
        if len(members) > 1:
            best = min(members, key=rank)
            winners[best[0]] = ",".join(sorted({m[3] for m in members}))
            remap.update({m[0]: best[0] for m in members if m is not best})
    return {
        (i, e, remap.get(m, m), winners.get(i, s), "email_match" if i in winners else d)
        for i, e, m, s, d in rows if i not in remap
    }


@pytest.mark.parametrize("policy", [SkewPolicy(), TINY])
def test_email_merge(spark, policy):
    rows = golden()
    df = spark.createDataFrame(rows, GOLDEN).repartition(5)
    assert {tuple(r) for r in email_merge(df, policy=policy).collect()} == expected_email_merge(rows)


def test_email_merge_options(spark):
    rows = [("GT-1", "a@x", None, "payroll", "s", None), ("GT-2", "a@x", "M", "globaltech_hris", "s", None), ("GT-3", "a@x", "N", "payroll", "s", 7),
            ("GT-4", "b@x", "GT-6", "globaltech_hris", "s", None), ("AC-5", "b@x", "P", "acquiredco_api", "s", 5), ("GT-6", "b@x", None, "payroll", "s", 6),
            ("GT-7", None, "AC-5", "payroll", "s", None)]
    df = spark.createDataFrame(rows, f"{GOLDEN}, grade int").repartition(3)

    def merge(**options):
        return {r.employee_id: (r.manager_id, r.grade) for r in email_merge(df, policy=TINY, **options).collect()}

    assert merge() == {"GT-2": ("M", None), "GT-4": ("GT-4", None), "GT-7": ("GT-4", None)}
    assert merge(coalesce=True) == {"GT-2": ("M", 7), "GT-4": ("GT-4", 5), "GT-7": ("GT-4", None)}
    alone = {"GT-1": (None, None), "GT-2": ("M", None), "GT-3": ("N", 7)}
    assert merge(require_distinct_prefix=True) == alone | {"GT-4": ("GT-4", None), "GT-7": ("GT-4", None)}
    assert merge(require_distinct_prefix=True, coalesce=True) == alone | {"GT-4": ("GT-4", 5), "GT-7": ("GT-4", None)}


def test_email_merge_without_shared_addresses(spark):
    rows = [("A", None, "B", "payroll", "single_source"), ("B", "b@x", None, "payroll", "single_source")]
    df = spark.createDataFrame(rows, GOLDEN)
    assert {tuple(r) for r in email_merge(df).collect()} == set(rows)


def test_provenance_can_be_normalised(spark):
    rows = [("A", "e", None, "benefits,payroll", "x"), ("B", "e", None, "acquiredco_api,payroll", "x")]
    df = spark.createDataFrame(rows, GOLDEN)
    assert email_groups(df).first().merged_sources == "acquiredco_api,payroll,benefits,payroll"
    assert email_groups(df, normalise=True).first().merged_sources == "acquiredco_api,benefits,payroll"


def test_loser_map_and_remap(spark):
    rows = golden()
    df = spark.createDataFrame(rows, GOLDEN)
    ids = loser_map(email_members(df, email_groups(df)))
    mapping = {r.loser_id: r.winner_id for r in ids.collect()}
    assert not set(mapping) & set(mapping.values())
    done = {r.employee_id: r.manager_id for r in remap_reference(df, ids, policy=TINY).collect()}
    assert done == {r[0]: mapping.get(r[2], r[2]) for r in rows}


@pytest.mark.parametrize("policy", [SkewPolicy(), TINY, SkewPolicy(share=1)])
def test_lookup_equals_a_left_join(spark, policy):
    rng = random.Random(1)
    left = [(i, rng.choice([None, "hot", "hot", "alsohot", f"k{rng.randrange(20)}"])) for i in range(200)]
    right = [("hot", 1, "a"), ("k1", 2, None), ("k2", None, "c"), ("unused", 4, "d")]
    table = {k: (v, w) for k, v, w in right}
    out = lookup(spark.createDataFrame(left, "id int, k string"), spark.createDataFrame(right, "k string, v int, w string"), "k", "id", policy)
    assert {tuple(r) for r in out.collect()} == {(i, k, *table.get(k, (None, None))) for i, k in left}
    assert out.count() == len(left)


def test_hot_keys_are_those_with_their_share(spark):
    df = spark.createDataFrame([(f"k{i % 10}",) for i in range(100)] + [(None,)] * 50, "k string")
    assert hot_keys(df, "k", SkewPolicy(share=10)).count() == 10
    assert hot_keys(df, "k", SkewPolicy(share=3)).count() == 0
    assert hot_keys(df.where("k is null"), "k", SkewPolicy(share=3)).count() == 0
    assert hot_keys(df.limit(0), "k", SkewPolicy()).count() == 0


@pytest.mark.parametrize("share", [7, 64, 700])
def test_no_hot_key_is_missed(spark, share):
    # Far more keys than the sketch has counters, of sizes that fall slowly, in mixed order.
    df = spark.range(0, 400_000, 1, 9).selectExpr("concat('k', cast(floor(pow(rand(3), 4) * 60000) as int)) k").cache()
    sizes = {r.k: r["count"] for r in df.groupBy("k").count().collect()}
    listed = {r.k for r in hot_keys(df, "k", SkewPolicy(share=share)).collect()}
    assert {k for k, n in sizes.items() if n * share >= 400_000} <= listed
    assert all(3 * n * share >= 2 * 400_000 for n in (sizes[k] for k in listed)) and len(listed) <= 2 * share


def test_many_hot_keys_need_no_list_of_their_own(spark):
    # More hot keys than any fixed list would hold: a key is hot by its share alone, and the result is that of a join.
    left = spark.range(0, 120_000, 1, 6).selectExpr("id", "concat('k', id % 30000) k")
    right = spark.range(0, 30_000, 2).selectExpr("concat('k', id) k", "id v")
    for policy in (SkewPolicy(), SkewPolicy(share=40_000)):
        out = lookup(left, right, "k", "id", policy)
        assert out.exceptAll(left.join(right, "k", "left").select("id", "k", "v")).isEmpty() and out.count() == 120_000
    assert hot_keys(left, "k", SkewPolicy(share=40_000)).count() == 30_000


def test_ghosts_agree_with_the_anti_join(spark):
    rows = [(k, *r[1:]) for k, r in ((f"K{i % 90}", r) for i, r in enumerate(records()))]
    df = spark.createDataFrame(rows, RECORDS)
    wide = exact_merge(df).selectExpr("*", "first_name AS last_name", "base_salary AS salary_usd_annual")
    found = {r.payroll_employee_id for r in ghosts(wide).collect()}
    assert found == {r.employee_id for r in payroll_only_ids(df).collect()} and found
    assert ghosts(wide).first().ghost_flag_reason == "Payroll record with no matching HRIS entry"
