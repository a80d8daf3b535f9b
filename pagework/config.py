"""Run parameters. These are settings of a job, never data, so they live on the driver."""

from __future__ import annotations

import re
from dataclasses import dataclass, field


def _bounded(name: str, value: float, low: float, high: float) -> None:
    if not low <= value <= high:
        raise ValueError(f"{name} must lie in {low}..{high}, got {value}")


@dataclass(frozen=True)
class PrunedOptions:
    """Settings of the ``pruned`` engine."""

    content_filter_threshold: float = 0.6
    remove_overlay_elements: bool = True

    def __post_init__(self) -> None:
        _bounded("content_filter_threshold", self.content_filter_threshold, 0.0, 1.0)


@dataclass(frozen=True)
class ArticleOptions:
    """Settings of the ``article`` engine."""

    output_format: str = "markdown"
    include_comments: bool = False
    include_tables: bool = True
    include_links: bool = False
    deduplicate: bool = True
    target_language: str = ""
    fingerprint: bool = False  # of the text, in the metadata

    def __post_init__(self) -> None:
        if not re.fullmatch(r"([a-z]{2})?", self.target_language):
            raise ValueError("target_language must be empty or a two-letter lower-case code")


@dataclass(frozen=True)
class Config:
    """``engine_order`` is both the list of enabled engines and the order they are tried in; an
    empty order means every registered engine in registration order."""

    engine_order: tuple[str, ...] = ("pruned",)
    max_content_length: int = 8000
    pruned: PrunedOptions = field(default_factory=PrunedOptions)
    article: ArticleOptions = field(default_factory=ArticleOptions)

    def __post_init__(self) -> None:
        _bounded("max_content_length", self.max_content_length, 500, 50_000)
        object.__setattr__(self, "engine_order", tuple(self.engine_order))
