"""The source registry: a table of publishers, read from TOML."""

from __future__ import annotations

import tomllib
from dataclasses import asdict, dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from corpusloom.errors import InvalidArgument
from corpusloom.schemas import DEFAULT_OVERLAP_TOKENS, DEFAULT_TARGET_TOKENS
from corpusloom.sources.html import RULES

BUILT_IN = Path(__file__).with_name("registry.toml")


@dataclass(frozen=True)
class Source:
    publisher_id: str
    publisher_name: str = ""
    base_url: str = ""
    host: str = ""
    series_id: str = "flagship"
    series_title: str = ""
    primary_series_url: str = ""
    rights_code: str = "unknown"
    rights_summary: str = ""
    country_region: list[str] = field(default_factory=list)
    industry_tags: list[str] = field(default_factory=list)
    function_tags: list[str] = field(default_factory=list)
    business_model_tags: list[str] = field(default_factory=list)
    source_type: str = "podcast_transcript_html"
    language: str = "en"
    credibility_notes: str = ""
    episodes: list[str] = field(default_factory=list)
    target_tokens: int = DEFAULT_TARGET_TOKENS
    overlap_tokens: int = DEFAULT_OVERLAP_TOKENS


def load_registry(path: str | Path = BUILT_IN) -> dict[str, Source]:
    """Sources by id in sorted order; an id without extraction rules is refused."""
    with open(path, "rb") as f:
        sections = tomllib.load(f).get("sources", {})
    found = {}
    for name in sorted(sections):
        if name not in RULES:
            raise InvalidArgument(f"no source is called {name!r}")
        values = dict(sections[name])
        values |= values.pop("chunking_policy", {})
        known = Source.__dataclass_fields__
        found[name] = Source(publisher_id=name, **{k: v for k, v in values.items() if k in known})
    return found


def registry_frame(spark: SparkSession, sources: dict[str, Source]) -> DataFrame:
    lists = "country_region industry_tags function_tags business_model_tags episodes".split()
    schema = ", ".join(f"{f} {'array<string>' if f in lists else 'int' if f.endswith('_tokens') else 'string'}" for f in Source.__dataclass_fields__)
    return spark.createDataFrame([tuple(asdict(s).values()) for s in sources.values()], schema)
