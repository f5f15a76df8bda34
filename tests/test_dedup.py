import pytest
from pyspark.sql import functions as F

from probelake.operators.dedup import deduplicate, deduplicate_stored

ROWS = [("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z"), (None, 3, "p"), (None, 4, "q")]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "row_id string, n int, t string")


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_first_by_order(rows):
    assert result(deduplicate(rows, order_by=["n"])) == [("a", 1, "y"), ("b", 5, "z"), (None, 3, "p")]


def test_null_keys_can_stay(rows):
    kept = deduplicate(rows, order_by=["n"], null_keys="keep")
    assert result(kept) == [("a", 1, "y"), ("b", 5, "z"), (None, 3, "p"), (None, 4, "q")]


def test_arbitrary_keeps_one_per_key(rows):
    kept = result(deduplicate(rows, keep="arbitrary"))
    assert len(kept) == 3 and set(kept) <= set(ROWS)


def test_survivor_does_not_depend_on_the_order_of_rows(spark, rows):
    survivors = {
        str(result(deduplicate(rows.orderBy(F.rand(seed)).repartition(3)))) for seed in range(4)
    }
    assert len(survivors) == 1


def test_within_other_columns(spark):
    rows = spark.createDataFrame([("d1", "a"), ("d1", "a"), ("d2", "a")], "day string, row_id string")
    assert result(deduplicate(rows, within=["day"])) == [("d1", "a"), ("d2", "a")]


def test_nested_columns(spark):
    rows = spark.sql("SELECT explode(array('a', 'a')) row_id, array(named_struct('x', 1, 'y', array('z'))) q")
    assert deduplicate(rows).count() == 1


@pytest.mark.parametrize("option", [{"keep": "last"}, {"null_keys": "drop"}])
def test_unknown_options(rows, option):
    with pytest.raises(ValueError):
        deduplicate(rows, **option)


def test_hot_key_is_cut_before_the_shuffle(spark):
    """A key with nearly all rows sends one row per task to the task that owns it."""
    rows = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") < 390_000, "hot").otherwise(F.col("id").cast("string")).alias("row_id"), "id"
    )
    kept = deduplicate(rows, order_by=["id"])
    assert kept.where("row_id = 'hot'").first().id == 0 and kept.count() == 10_001
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("1, Final") < plan.index("Exchange hashpartitioning") < plan.index("1, Partial")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_copy_with_a_broken_value_does_not_win(spark):
    rows = spark.createDataFrame([("k", None, 1), ("k", 5, 2), (None, None, 3), (None, 1, 4)], "row_id string, t int, n int")
    assert sorted(r.n for r in deduplicate(rows, order_by=["t"]).collect()) == [2, 4]


@pytest.mark.parametrize("null_keys", ["collapse", "keep"])
@pytest.mark.parametrize("few_keys", [0, 100])
def test_a_stored_table_gives_the_same_rows(spark, tmp_path, null_keys, few_keys):
    rows = [(f"k{i % 7}" if i % 3 else f"own{i}", "f" if i % 2 else None, i) for i in range(60)]
    rows += [(None, "f", 1000), (None, "f", 1001), (None, None, 1002)]
    spark.createDataFrame(rows, "row_id string, folder string, n int").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    options = {"order_by": ["n"], "within": ["folder"], "null_keys": null_keys}
    expected = sorted(map(str, deduplicate(stored, **options).collect()))
    assert sorted(map(str, deduplicate_stored(stored, few_keys=few_keys, **options).collect())) == expected


def test_rows_without_copies_are_not_shuffled(spark, tmp_path):
    spark.range(100).selectExpr("cast(id as string) AS row_id", "repeat('x', 100) AS wide").write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert "Exchange" not in _plan(deduplicate_stored(stored))
    copied = stored.unionByName(stored.where("row_id = '7'"))
    assert deduplicate_stored(copied).count() == 100


def test_rows_without_key_are_kept_in_one_pass(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"row_id": "a"}\n{"row_id": "a"}\n{}\n{}\n')
    rows = spark.read.schema("row_id string, n int").json(str(tmp_path))
    kept = deduplicate(rows, null_keys="keep")
    assert kept.count() == 3 and _plan(kept).count("FileScan json") == 1
