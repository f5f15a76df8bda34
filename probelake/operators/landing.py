"""Choice of the source objects to land: manifest, filters, what is there already, size budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probelake import fixed
from probelake.functions.paths import destination_key, key_part, relative_key, to_mib
from probelake.session import stage

PART, CLASS = "__in_part", "__class"
#: Rows by part of a group that are sent to every task, some 100 bytes each; if they are more, joins sort both sides.
FEW_PLACES = 200_000


def manifest(objects: DataFrame, root: str, date_index: int = 0) -> DataFrame:
    """Parse an object listing (``path``, ``length``) into one row per measurement file.

    Keys below ``root`` are ``<...>/<date>/<time>-<country>-<x>-<test type>-...`` with the date as part
    ``date_index``. Directory markers and names with too few parts are left out.
    """
    keyed = objects.where(~F.col("path").endswith("/")).select(
        "path", "length", relative_key(F.col("path"), root).alias("key")
    )
    name = key_part(F.col("key"), date_index + 1)
    return keyed.select(
        "path",
        "key",
        key_part(F.col("key"), date_index).alias("source_date"),
        key_part(name, 1, "-").alias("country"),
        key_part(name, 3, "-").alias("test_type"),
        to_mib(F.col("length")).alias("size_mb"),
        destination_key(key_part(F.col("key"), date_index), F.col("key")).alias("dest_key"),
    ).where(F.col("test_type").isNotNull())


def wanted(
    files: DataFrame,
    test_type: str = fixed.TEST_TYPE,
    countries: Sequence[str] = fixed.LANDING_COUNTRIES,
    min_mib: float = fixed.MIN_FILE_MIB,
) -> DataFrame:
    return files.where(
        (F.col("test_type") == test_type)
        & F.col("country").isin(*countries)
        & (F.col("size_mb") >= min_mib)
    )


def not_landed(files: DataFrame, landed: DataFrame, key: str = "dest_key") -> DataFrame:
    """Files whose destination does not exist yet. Of ``landed``, if it lies in buckets of the key, no row moves."""
    return files.join(landed.select(key), key, "left_anti")


def within_budget(
    files: DataFrame,
    limit_mib: float = fixed.COUNTRY_LIMIT_MIB,
    min_mib: float = fixed.MIN_FILE_MIB,
    group: Sequence[str] = ("source_date", "country"),
    key: str = "key",
    size: str = "size_mb",
) -> DataFrame:
    """First-fit choice of files per group, in order of their (unique) keys, up to ``limit_mib`` in total.

    A file is taken if it has at least ``min_mib`` and still fits next to those taken before it; one that does not fit is
    passed over and smaller ones after it may still fit. That is a sequential rule, but it changes course seldom. Files
    are classed by size, each class up to twice the size of the one below. When a file is passed over, less than twice
    the least of its class is left: larger ones never fit again, of that class one more at most, and the smaller
    classes go on. So a round takes all files of the smaller classes up to the first that does not fit or, if that comes
    first, up to the first of the last class that does; it is a search over sums, for all groups at once. There are at
    most two rounds for each class whatever the files are, nine classes with the usual limits, and one round if all fits.

    The files of a group lie in parts by order of their keys, so no task has more than a part of a group. What goes from
    round to round is a row per group. Files never go through the driver, however small their table is stored: its size
    says little about its rows.
    """
    if min_mib <= 0:
        raise ValueError("min_mib must be above 0: it bounds the number of files taken")
    budget = _Budget(list(group), key, size, float(limit_mib), float(min_mib))
    candidates = files.where((F.col(size) >= min_mib) & (F.col(size) <= limit_mib))
    candidates = candidates.repartitionByRange(*group, key)
    candidates = stage(candidates.select("*", F.spark_partition_id().alias(PART), budget.class_of().alias(CLASS)), "candidates")
    parts = stage(candidates.groupBy(*group, PART).agg(F.sum(size).alias("sum")), "parts")
    budget.few = parts.count() <= FEW_PLACES
    state = parts.select(*group).distinct().select(
        "*", F.lit(None).cast(files.schema[key].dataType).alias("after"), F.lit(0.0).alias("used"),
        F.lit(len(budget.bounds) + 1).alias("last"),
    )
    rounds = []
    while True:
        event = budget.events(candidates, parts, state, first=not rounds)
        if event is None:
            if not rounds:
                return candidates.select(files.columns)
            nothing = f"struct<key:{files.schema[key].dataType.simpleString()}>"
            rounds.append(state.select("*", F.lit(None).cast(nothing).alias("event")))
            break
        told = stage(budget.same_group(state, event), "budget")
        rounds.append(told.drop("next"))
        state = told.where("next IS NOT NULL").select(*group, "next.*")
    return budget.taken(candidates, parts, rounds).select(files.columns)


class _Budget:
    """The rounds of ``within_budget``.

    A state is a row per group: ``after``, the key up to which all is decided, what is ``used``, and the ``last`` class, of
    which at most one more file fits; files of smaller classes are taken as they come.
    """

    def __init__(self, group: list[str], key: str, size: str, limit: float, least: float):
        self.group, self.key, self.size, self.limit = group, key, size, limit
        self.few = False
        self.bounds = []
        while (bound := least * 2.0 ** (len(self.bounds) + 1)) <= limit:
            self.bounds.append(bound)

    def class_of(self) -> Column:
        total = F.lit(0)
        for bound in self.bounds:
            total = total + (F.col(self.size) >= bound).cast("int")
        return total

    def _by_group(self, small: DataFrame, more: Sequence[str] = ()) -> tuple[DataFrame, list[Column]]:
        """``small`` with other names for the columns that it is joined by, and the condition. By the sizes that Spark
        expects it could send the other side to every task."""
        names = [*self.group, *more]
        renamed = small.select(*[F.col(c).alias(f"__{c}") if c in names else F.col(c) for c in small.columns])
        renamed = renamed.hint("broadcast" if self.few else "merge")
        return renamed, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in names]

    def same_group(self, state: DataFrame, event: DataFrame) -> DataFrame:
        renamed, same = self._by_group(event)
        return state.join(renamed, same, "left").drop(*[f"__{c}" for c in self.group])

    def _open(self, candidates: DataFrame, parts: DataFrame) -> DataFrame:
        """Files that can still be taken, with the state of their group; ``parts`` has it for each of its parts."""
        renamed, same = self._by_group(parts, [PART])
        narrow = candidates.select(*self.group, PART, CLASS, self.key, self.size)
        joined = narrow.join(renamed, same).drop(*[f"__{c}" for c in [*self.group, PART]])
        later = F.col("after").isNull() | (F.col(self.key) > F.col("after"))
        return joined.where(later & (F.col(CLASS) <= F.col("last")) & (F.col(self.size) <= self.limit - F.col("used")))

    def events(self, candidates: DataFrame, parts: DataFrame, state: DataFrame, first: bool) -> DataFrame | None:
        """Where the course of a group changes next, a row (``event``, ``next``) for groups where it does; None: nowhere."""
        renamed, same = self._by_group(state)
        places = parts.join(renamed, same).drop(*[f"__{c}" for c in self.group])
        normal = F.col(CLASS) < F.col("last")
        if first:
            sums = places.withColumn("least", F.lit(None).cast("double"))
        else:
            sums = self._open(candidates, places.drop("sum")).groupBy(*self.group, PART, "after", "used", "last").agg(
                F.coalesce(F.sum(F.when(normal, F.col(self.size))), F.lit(0.0)).alias("sum"),
                F.min(F.when(~normal, F.col(self.size))).alias("least"),
            )
        in_order = Window.partitionBy(*self.group).orderBy(PART)
        before = in_order.rowsBetween(Window.unboundedPreceding, -1)
        offset = F.col("used") + F.coalesce(F.sum("sum").over(before), F.lit(0.0))
        over = F.col("offset") + F.col("sum") > self.limit
        fits = F.coalesce(F.col("least") <= self.limit - F.col("offset"), F.lit(False))
        told = sums.withColumn("offset", offset).withColumn("over", over)
        told = told.withColumn("over_before", F.coalesce(F.max("over").over(before), F.lit(False)))
        searched = stage(told.where(~F.col("over_before") & (over | fits)).select(*self.group, PART, "after", "used", "last", "offset"), "searched")
        if searched.isEmpty():
            return None
        rows = self._open(candidates, searched)
        in_part = Window.partitionBy(*self.group, PART).orderBy(self.key)
        running = F.col("offset") + F.sum(F.when(normal, F.col(self.size)).otherwise(0.0)).over(in_part)
        rows = rows.withColumn("running", running)
        missed = normal & (F.col("running") > self.limit)
        taken = ~normal & (F.col("running") + F.col(self.size) <= self.limit)
        used = F.when(taken, F.col("running") + F.col(self.size)).otherwise(F.col("running") - F.col(self.size))
        last = F.when(taken, F.col("last")).otherwise(F.col(CLASS))
        event = F.struct(F.col(self.key).alias("key"), taken.alias("taken"))
        following = F.struct(F.col(self.key).alias("after"), used.alias("used"), last.alias("last"))
        found = rows.where(missed | taken).groupBy(*self.group).agg(
            F.min(F.struct(event.alias("event"), following.alias("next"))).alias("first")
        )
        found = stage(found.select(*self.group, "first.*"), "events")
        return found

    def taken(self, candidates: DataFrame, parts: DataFrame, rounds: list[DataFrame]) -> DataFrame:
        """The files that some round of their group has taken; a group has a few rounds, whatever its size."""
        told = None
        for rows in rounds:
            key, taken = F.col("event")["key"], F.lit(False)
            if "taken" in rows.schema["event"].dataType.names:
                taken = F.coalesce(F.col("event")["taken"], F.lit(False))
            row = F.struct("after", key.alias("until"), taken.alias("taken"), "last", (self.limit - F.col("used")).alias("room"))
            some = rows.select(*self.group, row.alias("round"))
            told = some if told is None else told.unionByName(some)
        told = told.groupBy(*self.group).agg(F.collect_list("round").alias("__rounds"))
        renamed, same = self._by_group(told)
        places = parts.drop("sum").join(renamed, same).drop(*[f"__{c}" for c in self.group])
        renamed, same = self._by_group(places, [PART])
        key = F.col(self.key)

        def has(r: Column) -> Column:
            inside = (r["after"].isNull() | (key > r["after"])) & (r["until"].isNull() | (key < r["until"]))
            whole = inside & (F.col(CLASS) < r["last"]) & (F.col(self.size) <= r["room"])
            return whole | (r["taken"] & (key == r["until"]))

        return candidates.join(renamed, same).where(F.exists("__rounds", has))
