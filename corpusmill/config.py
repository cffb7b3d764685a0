"""Settings of the curation stages, as frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field

# The crawl snapshots by name.
ALL_DUMPS = (
    "2013-20", "2013-48", "2014-10", "2014-15", "2014-23", "2014-35", "2014-41", "2014-42", "2014-49", "2014-52",
    "2015-06", "2015-11", "2015-14", "2015-18", "2015-22", "2015-27", "2015-32", "2015-35", "2015-40", "2015-48",
    "2016-07", "2016-18", "2016-22", "2016-26", "2016-30", "2016-36", "2016-40", "2016-44", "2016-50", "2017-04",
    "2017-09", "2017-13", "2017-17", "2017-22", "2017-26", "2017-30", "2017-34", "2017-39", "2017-43", "2017-47",
    "2017-51", "2018-05", "2018-09", "2018-13", "2018-17", "2018-22", "2018-26", "2018-30", "2018-34", "2018-39",
    "2018-43", "2018-47", "2018-51", "2019-04", "2019-09", "2019-13", "2019-18", "2019-22", "2019-26", "2019-30",
    "2019-35", "2019-39", "2019-43", "2019-47", "2019-51", "2020-05", "2020-10", "2020-16", "2020-24", "2020-29",
    "2020-34", "2020-40", "2020-45", "2020-50", "2021-04", "2021-10", "2021-17", "2021-21", "2021-25", "2021-31",
    "2021-39", "2021-43", "2021-49", "2022-05", "2022-21", "2022-27", "2022-33", "2022-40", "2022-49", "2023-06",
    "2023-14", "2023-23", "2023-40", "2023-50", "2024-10", "2024-18", "2024-22", "2024-26",
)

NUM_SHARDS = 1000


@dataclass(frozen=True)
class FilterConfig:
    """Bounds of the quality filter, all inclusive.

    ``apply_entropy`` turns on a rule that the established behaviour names but never applies.
    """

    content_length: tuple[float, float] = (100, 1e10)
    alphanumeric: tuple[float, float] = (0.4, 1.0)
    headings: tuple[float, float] = (0.0, 0.05)
    entropy: tuple[float, float] = (3.0, 100.0)
    apply_entropy: bool = False
    blacklisted_domains: tuple[str, ...] = ()
    #: What a URL without a domain gets: "keep" marks it blacklisted, anything else does not.
    parse_error_strategy: str = "keep"


@dataclass(frozen=True)
class MinHashConfig:
    """Shingles are 2 ** ``shingle_log2`` characters wide."""

    buckets: int = 14
    bucket_size: int = 8
    shingle_log2: int = 4
    seed: int = 0x5EED


@dataclass(frozen=True)
class LineConfig:
    threshold: float = 0.05
    strict: bool = False
    #: Split on every Unicode line boundary as well, which misaligns scores on such texts.
    compat_boundaries: bool = False


@dataclass(frozen=True)
class PipelineConfig:
    filters: FilterConfig = field(default_factory=FilterConfig)
    minhash: MinHashConfig = field(default_factory=MinHashConfig)
    lines: LineConfig = field(default_factory=LineConfig)
    #: "global" dedups over all input; a column name dedups within its values.
    dedup_scope: str = "global"
    #: Dedup sees texts that fail the filter too, unless this is set.
    restrict_dedup_to_passing: bool = False
