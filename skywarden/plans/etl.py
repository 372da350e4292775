"""From raw lines to processed records: filter, mask, split, tag, extract."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skywarden.operators.extract import core_params, extract_book, extract_query
from skywarden.operators.line import to_line
from skywarden.operators.mask import mask_pii
from skywarden.operators.parse import parse_requests
from skywarden.operators.patterns import tag_request_type_by_join
from skywarden.operators.tag import drop_noise_lines, flag_known_ip, tag_request_type, tag_travel_type
from skywarden.plans import rules as site_rules
from skywarden.schema import ClassifyRule, ParseRule


@dataclass
class Site:
    """What a site configures; the known addresses are a table, classify rules may be one (``readers.classify_rules``),
    the rest are short lists."""

    noise: Sequence[str] = field(default_factory=lambda: site_rules.NOISE)
    classify: Sequence[ClassifyRule] | DataFrame = field(default_factory=lambda: site_rules.CLASSIFY)
    query_rules: Sequence[ParseRule] = field(default_factory=lambda: site_rules.QUERY_RULES)
    book_rules: Sequence[ParseRule] = field(default_factory=lambda: site_rules.BOOK_RULES)
    known: DataFrame | None = None


def tagged_requests(lines: DataFrame, site: Site) -> DataFrame:
    """Filtered, masked, split and tagged requests."""
    df = parse_requests(mask_pii(drop_noise_lines(lines, site.noise)))
    spread = ["time_iso8601", "http_user_agent", "jsessionid", "userid"]
    if isinstance(site.classify, DataFrame):
        df = tag_request_type_by_join(df, site.classify, spread=spread)
    else:
        df = tag_request_type(df, site.classify)
    df = tag_travel_type(df)
    if site.known is None:
        return df.withColumn("high_freq_ip", F.lit(False))
    return flag_known_ip(df, site.known, spread=spread)


def process_lines(lines: DataFrame, site: Site) -> DataFrame:
    """Processed records with both data records and core parameters."""
    df = tagged_requests(lines, site)
    return core_params(extract_book(extract_query(df, site.query_rules), site.book_rules))


def processed_lines(lines: DataFrame, site: Site, keep: Sequence[str] = ()) -> DataFrame:
    """Processed records as lines."""
    return to_line(process_lines(lines, site)).select(*keep, "behavior_type", "remote_addr", "value")
