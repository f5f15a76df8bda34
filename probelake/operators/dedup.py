"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from probelake.session import stage

# Rows of a stored table of which a bit each is sent to every executor: 32 MB.
FEW_ROWS = 2**28
# Keys that occur more than once are sent to every executor up to this number; a key is some 100 bytes.
FEW_KEYS = 200_000
_FILE, _PIECE, _BIT = "__file", "__piece", "__bit"


def deduplicate(
    df: DataFrame,
    key: str = "row_id",
    keep: str = "first",
    order_by: Sequence[Column | str] = (),
    within: Sequence[str] = (),
    null_keys: str = "collapse",
) -> DataFrame:
    """Keep one row per ``key`` (per value of the ``within`` columns, if given).

    ``keep="first"`` keeps the first row by ``order_by`` (columns by name: NULLs last, so that a copy whose
    value is broken does not win), then by content, so that a recomputed partition gives the same survivor;
    ``"arbitrary"`` keeps any. ``null_keys="collapse"`` treats NULL as one more key, ``"keep"`` leaves all
    rows without a key in place.

    Both ways reduce each key to one row per task before the shuffle, so that a key with very many
    copies sends few rows to the task that owns it.
    """
    if null_keys not in ("collapse", "keep"):
        raise ValueError(f"null_keys must be collapse or keep, not {null_keys!r}")
    if keep not in ("first", "arbitrary"):
        raise ValueError(f"keep must be first or arbitrary, not {keep!r}")
    rank, own = "__rank", "__own"
    keys, rows = [*within, key], df
    if null_keys == "keep":
        # A row without a key is a copy of none: it gets a number of its own as one more part of the key.
        number = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
        keys, rows = [*keys, own], df.withColumn(own, number)
    if keep == "arbitrary":
        return rows.dropDuplicates(keys).drop(own)
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]
    copies = Window.partitionBy(*keys).orderBy(*order, content)
    return rows.withColumn(rank, F.row_number().over(copies)).where(F.col(rank) == 1).drop(rank, own)


def deduplicate_stored(
    df: DataFrame,
    key: str = "row_id",
    keep: str = "first",
    order_by: Sequence[Column | str] = (),
    within: Sequence[str] = (),
    null_keys: str = "collapse",
    few_keys: int = FEW_KEYS,
    few_rows: int = FEW_ROWS,
) -> DataFrame:
    """The same rows as ``deduplicate`` for a table that is stored and can be read several times.

    The keys are counted first, from the key columns alone. Rows whose key occurs once then pass without a
    shuffle; only those of the keys that occur more often are compared. If these keys are more than
    ``few_keys``, the key and order of all rows are compared, and the places of the rows that stay, a bit for each row
    of the table, tell which to read. Beyond ``few_rows`` all rows are compared whole as in ``deduplicate``.
    """
    keys = [*within, key]
    named = df if null_keys == "collapse" else df.where(F.col(key).isNotNull())
    counts = named.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where("__rows > 1")
    repeated = stage(counts.select(*[F.col(c).alias(f"__{c}") for c in keys]), "repeated")
    n = repeated.count()
    if n == 0:
        return df
    if n > few_keys:
        placed = _placed(df)
        if placed is None or df.count() > few_rows:
            return deduplicate(df, key, keep, order_by, within, null_keys)
        return _at_places(placed, key, keep, order_by, within, null_keys).select(df.columns)
    few = F.broadcast(repeated)
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys]
    copies = deduplicate(df.join(few, same, "left_semi"), key, keep, order_by, within, null_keys)
    return df.join(few, same, "left_anti").unionByName(copies)


def _placed(df: DataFrame) -> DataFrame | None:
    """The rows of a Parquet scan with their places, a file and a number there; None if ``df`` is no such scan."""
    try:
        return df.select(
            "*",
            F.col("_metadata.file_path").alias(_FILE),
            F.bitmap_bucket_number(F.col("_metadata.row_index") + 1).alias(_PIECE),
            F.bitmap_bit_position(F.col("_metadata.row_index") + 1).alias(_BIT),
        )
    except AnalysisException:
        return None


def _at_places(
    placed: DataFrame, key: str, keep: str, order_by: Sequence[Column | str], within: Sequence[str], null_keys: str
) -> DataFrame:
    """Survivors by their places: what decides between copies is shuffled, the other columns of the rows are not."""
    named = placed if null_keys == "collapse" else placed.where(F.col(key).isNotNull())
    place = [_FILE, _PIECE, _BIT]
    # The content has to be that of the row, as in ``deduplicate``.
    content = F.xxhash64(*[F.col(f"`{c}`") for c in placed.columns if c not in place])
    order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]
    copies = Window.partitionBy(*within, key).orderBy(*order, F.col("__content"))
    ranked = named.withColumn("__content", content).withColumn("__rank", F.row_number().over(copies))
    bits = F.bitmap_construct_agg(_BIT).alias("__bits")
    stay = ranked.where(F.col("__rank") == 1).groupBy(*[F.col(c).alias(f"{c}_of") for c in place[:2]]).agg(bits)
    stay = F.broadcast(stage(stay, "survivors"))
    byte = F.expr(f"substring(__bits, cast({_BIT} div 8 as int) + 1, 1)")
    kept = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col(_BIT) % 8).cast("int")) == 1
    kept = F.coalesce(kept, F.lit(False))
    if null_keys == "keep":
        kept = kept | F.col(key).isNull()
    same = [F.col(c) == F.col(f"{c}_of") for c in place[:2]]
    return placed.join(stay, same, "left").where(kept)
