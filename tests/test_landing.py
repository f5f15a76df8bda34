import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from probelake.operators import landing
from probelake.operators.landing import manifest, not_landed, wanted, within_budget
from probelake.plans.ingest import copy_tasks

FILES = "source_date string, country string, key string, size_mb double"


def first_fit(files, limit, minimum):
    used, taken = {}, set()
    for date, country, key, size in sorted(files, key=lambda f: f[2].encode()):
        total = used.get((date, country), 0.0)
        if size >= minimum and total + size <= limit:
            used[date, country] = total + size
            taken.add((date, country, key))
    return taken


def chosen(spark, files, limit, minimum, **options):
    rows = within_budget(spark.createDataFrame(files, FILES), limit, minimum, **options).collect()
    keys = [(r.source_date, r.country, r.key) for r in rows]
    assert len(keys) == len(set(keys))
    return set(keys)


def test_a_file_too_large_is_passed_over(spark):
    sizes = [60.0, 50.0, 0.1, 40.0, 0.3]
    files = [("d", "BR", f"k{i}", s) for i, s in enumerate(sizes)]
    assert {k for _, _, k in chosen(spark, files, 100.0, 0.3)} == {"k0", "k3"}


def test_bounds_are_inclusive(spark):
    files = [("d", "BR", "a", 0.3), ("d", "BR", "b", 99.7), ("d", "DE", "c", 100.0)]
    assert len(chosen(spark, files, 100.0, 0.3)) == 3


def test_groups_have_their_own_budget(spark):
    files = [(d, c, f"{d}{c}", 80.0) for d in ("1", "2") for c in ("BR", "DE")] + [(None, "BR", "x", 80.0)]
    assert len(chosen(spark, files, 100.0, 0.3)) == 5


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.data())
def test_same_as_a_loop(spark, data):
    """Whatever the sizes."""
    size = st.integers(0, 4 * 1024).map(lambda n: n / 1024)
    groups = st.tuples(st.sampled_from(["1", "2", None]), st.sampled_from(["BR", "DE"]), size)
    files = [
        (date, country, f"{i * 7919 % 1000:03d}é{i}", mib)
        for i, (date, country, mib) in enumerate(data.draw(st.lists(groups, min_size=1, max_size=60)))
    ]
    limit = data.draw(st.sampled_from([0.3, 1.5, 6.0, 20.0]))
    assert chosen(spark, files, limit, 0.25) == first_fit(files, limit, 0.25)


def test_hot_group_over_many_rounds(spark):
    """Nine tenths of the files in one group, sizes falling so that hardly any fits after the first."""
    rng = random.Random(5)
    falling = [("d", "BR", f"{i:06d}", 9.0 - i * 0.0004) for i in range(20_000)]
    rest = [("d", "DE", f"{i:06d}", rng.uniform(0.1, 5.0)) for i in range(2_000)]
    files = falling + rest
    assert chosen(spark, files, 10.0, 0.3) == first_fit(files, 10.0, 0.3)


@pytest.fixture
def rounds(monkeypatch):
    """A row for each round of the choices made in a test."""
    found, events = [], landing._Budget.events
    monkeypatch.setattr(landing._Budget, "events", lambda *a, **k: found.append(1) or events(*a, **k))
    return found


def test_few_rounds_for_usual_sizes(spark, rounds):
    rng = random.Random(6)
    files = [("d", "BR", f"{i:06d}", rng.randrange(10, 20_000) / 1024) for i in range(30_000)]
    assert chosen(spark, files, 100.0, 0.3) == first_fit(files, 100.0, 0.3)
    assert len(rounds) <= 18


def test_rounds_do_not_grow_with_files_that_no_longer_fit(spark, rounds):
    """A small file, fifty that then no longer fit by a hair, and so on: every small file once was a round."""
    files, room = [], 20.0
    while room > 0.5:
        files.append(("d", "BR", f"{len(files):06d}", 0.25))
        room -= 0.25
        files += [("d", "BR", f"{len(files) + i:06d}", room + 2.0**-10 * (1 + i % 3)) for i in range(50)]
    assert chosen(spark, files, 20.0, 0.25) == first_fit(files, 20.0, 0.25)
    assert len(files) > 3000 and len(rounds) <= 2 * 7


def test_other_columns_come_along_in_order(spark):
    files = spark.createDataFrame([("p", "d", "BR", "k", 1.0, 7)], f"path string, {FILES}, n int")
    result = within_budget(files)
    assert result.columns == files.columns
    assert [tuple(r) for r in result.collect()] == [("p", "d", "BR", "k", 1.0, 7)]


def test_minimum_must_be_positive(spark):
    with pytest.raises(ValueError):
        within_budget(spark.createDataFrame([], FILES), min_mib=0.0)


def test_manifest(spark):
    objects = spark.createDataFrame(
        [
            ("s3://b/x/jsonl/2020-01-01/20200101T-BR-AS1-web_connectivity-r.json", 2 * 1024 * 1024),
            ("s3://b/x/jsonl/2020-01-01/short-name.json", 10),
            ("s3://b/x/jsonl/2020-01-01/", 0),
            ("s3://b/x/jsonl", 0),
        ],
        "path string, length bigint",
    )
    rows = [r.asDict() for r in manifest(objects, "s3://b", date_index=2).collect()]
    assert rows == [
        {
            "path": "s3://b/x/jsonl/2020-01-01/20200101T-BR-AS1-web_connectivity-r.json",
            "key": "x/jsonl/2020-01-01/20200101T-BR-AS1-web_connectivity-r.json",
            "source_date": "2020-01-01",
            "country": "BR",
            "test_type": "web_connectivity",
            "size_mb": 2.0,
            "dest_key": "2020-01-01/20200101T-BR-AS1-web_connectivity-r.json",
        }
    ]


def test_wanted(spark):
    files = spark.createDataFrame(
        [("web_connectivity", "BR", 0.3), ("web_connectivity", "BR", 0.29), ("web_connectivity", "FR", 1.0),
         ("dash", "BR", 1.0), ("web_connectivity", None, 1.0)],
        "test_type string, country string, size_mb double",
    )
    assert [tuple(r) for r in wanted(files).collect()] == [("web_connectivity", "BR", 0.3)]


def test_not_landed(spark):
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "dest_key string")
    landed = spark.createDataFrame([("b",), ("b",), (None,)], "dest_key string")
    left = not_landed(files, landed).orderBy("dest_key").collect()
    assert [r.dest_key for r in left] == ["a", "c"]


def test_a_large_group_that_fits_takes_one_round_and_no_search(spark, rounds):
    files = spark.range(100_000).selectExpr(
        "'d' AS source_date", "'BR' AS country", "lpad(cast(id as string), 6, '0') AS key", "0.5D AS size_mb"
    )
    result = within_budget(files, 1e9, 1e-6)
    assert result.count() == 100_000 and len(rounds) == 1
    assert "Join" not in result._jdf.queryExecution().executedPlan().toString()


def test_no_task_has_a_whole_group(spark):
    """The search of a round goes by parts of a group."""
    files = spark.createDataFrame([("d", "BR", f"{i:04d}", 1.0 + i % 7) for i in range(2000)], FILES)
    plan = within_budget(files, 100.0, 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("few", [True, False])
def test_files_are_never_sent_to_the_driver(spark, monkeypatch, few):
    """Many alike files take few bytes; a join that goes by these takes them for its small side."""
    if not few:
        monkeypatch.setattr(landing, "FEW_PLACES", 0)
    plans, staged = [], landing.stage
    plan_of = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(landing, "stage", lambda df, name: plans.append(plan_of(df)) or staged(df, name))
    files = [(d, "BR", f"{i:05d}", 1.0 + i % 7) for d in ("1", "2", None) for i in range(5000)]
    result = within_budget(spark.createDataFrame(files, FILES), 100.0, 0.3)
    plans.append(plan_of(result))
    assert {(r.source_date, r.country, r.key) for r in result.collect()} == first_fit(files, 100.0, 0.3)
    assert not [p for p in plans if "BuildLeft" in p or "NestedLoop" in p]
    assert ("BuildRight" if few else "SortMergeJoin") in plans[-1] and (few or not [p for p in plans if "Broadcast" in p])


def test_large_files_are_copied_by_tasks_of_their_own(spark):
    sizes = lambda *mib: spark.createDataFrame([(float(m),) for m in mib], "size_mb double")
    assert copy_tasks(sizes(5000, 5000)) == 2
    assert copy_tasks(sizes(*[1] * 500)) == spark.sparkContext.defaultParallelism
    assert copy_tasks(sizes(*[1024] * 500)) == 500
    assert copy_tasks(sizes(*[512] * 10_000, *[0.001] * 20_000)) == 20_001
    assert copy_tasks(sizes(1).limit(0)) == 1
