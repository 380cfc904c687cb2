"""Settings: typed values from the environment, with the session's own settings before them."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import SparkSession


def env_bool(name: str, default: bool = False, env: dict[str, str] | None = None) -> bool:
    """Unset gives the default; 1, true, yes and on (any case, blanks apart) are true."""
    value = (env or os.environ).get(name)
    return default if value is None else value.strip().lower() in {"1", "true", "yes", "on"}


@dataclass(frozen=True)
class Site:
    """Hosts of the crawled corpus: its own, those of its translations, and where its PDF files are."""

    base_url: str = "https://corpus.example"
    corpus_hosts: tuple[str, ...] = ("corpus.example", "www.corpus.example")
    translation_hosts: tuple[str, ...] = ("translation.example", "www.translation.example")
    data_host: str = "data.corpus.example"


@dataclass(frozen=True)
class Settings:
    embedding_model: str = "deterministic_hash"
    dimension: int = 384
    max_tokens: int = 800
    overlap: int = 100
    top_k: int = 50
    top_n: int = 5
    dense_weight: float = 0.35
    per_page: int = 100
    min_delay: float = 0.8
    max_delay: float = 2.4
    site: Site = field(default_factory=Site)

    @classmethod
    def of(cls, spark: SparkSession) -> Settings:
        """Values of spark.quillspark.<name> where they are set."""
        given = {}
        for name, kind in (("embedding_model", str), ("dimension", int), ("max_tokens", int), ("overlap", int), ("top_k", int), ("top_n", int), ("dense_weight", float), ("per_page", int), ("min_delay", float), ("max_delay", float)):
            value = spark.conf.get(f"spark.quillspark.{name}", None)
            if value is not None:
                given[name] = kind(value)
        return cls(**given)
