"""Settings of the jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from probelake import fixed
from probelake.operators.quality import Constraint, complete, contained, has_rows, unique

FOLDER_DATE = "landing_date"


@dataclass(frozen=True)
class Generation:
    """The two variants of the trusted and delivery tables."""

    name: str
    first_query_only: bool
    validity_flags: bool
    countries: tuple[str, ...]
    per_folder: bool  # key, check and repair each landing folder by itself
    partition_by: tuple[str, ...]
    overwrite: str
    drop_wide: bool

    @property
    def constraints(self) -> list[Constraint]:
        checks = [unique("row_id")]
        checks += [complete(column, share) for column, share in fixed.COMPLETENESS.items()]
        checks.append(contained("probe_cc", self.countries))
        if self.validity_flags:
            checks += [complete(c, share) for c, share in fixed.VALIDITY_COMPLETENESS.items()]
        return [*checks, has_rows()]

    @property
    def droppable(self) -> list[str]:
        extra = fixed.VALIDITY_COMPLETENESS if self.validity_flags else {}
        return [*fixed.COMPLETENESS, *extra]


GEN_1 = Generation(
    name="gen-1",
    first_query_only=False,
    validity_flags=True,
    countries=fixed.COUNTRIES_9,
    per_folder=False,
    partition_by=("bucket_date", "probe_cc"),
    overwrite="static",
    drop_wide=False,
)
GEN_2 = Generation(
    name="gen-2",
    first_query_only=True,
    validity_flags=False,
    countries=fixed.COUNTRIES_4,
    per_folder=True,
    partition_by=("bucket_date",),
    overwrite="dynamic",
    drop_wide=True,
)


@dataclass(frozen=True)
class LakeConfig:
    """Folders and parameters of one run."""

    source: str
    raw: str
    trusted: str
    delivery: str
    logs: str
    generation: Generation = GEN_2
    schema: str | None = None  # catalog schema; None registers no tables
    schema_location: str | None = None
    prefixes: Sequence[str] = ("",)  # key prefixes below source, e.g. months
    source_date_index: int = 0
    test_type: str = fixed.TEST_TYPE
    landing_countries: Sequence[str] = fixed.LANDING_COUNTRIES
    min_mib: float = fixed.MIN_FILE_MIB
    limit_mib: float = fixed.COUNTRY_LIMIT_MIB
    substring_match: bool = False
    null_keys: str = "collapse"
    #: How listings and copies reach each scheme, as keyword arguments of pyarrow's file system of that scheme, for
    #: example {"s3": {"access_key": ..., "secret_key": ..., "region": ...}}. By default as the environment tells.
    storage: Mapping[str, Mapping[str, object]] = field(default_factory=dict, hash=False, repr=False)


def months(year: int, first: int = 1, last: int = 10) -> list[str]:
    """Key prefixes of a backfill, one per month, both ends included."""
    return [f"{year}-{month:02d}" for month in range(first, last + 1)]


def small_landing(cfg: LakeConfig) -> LakeConfig:
    """The same run with the small budget per country, for sources with the date first in the key."""
    return replace(cfg, limit_mib=fixed.SMALL_COUNTRY_LIMIT_MIB, source_date_index=0)
