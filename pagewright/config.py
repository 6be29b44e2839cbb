"""Frozen configuration objects chosen at plan-build time.

Flags select which Column expressions enter the plan; nothing is decided per
row.  ``mode='compat'`` reproduces the reference order of steps (including
its quirks); ``mode='corrected'`` is the default for new pipelines.
"""

from __future__ import annotations

from dataclasses import dataclass, field

COMPAT = "compat"
CORRECTED = "corrected"


@dataclass(frozen=True)
class PageConfig:
    remove_linebreaks: bool = True
    remove_headers_footers: bool = True


@dataclass(frozen=True)
class CleanConfig:
    lowercase: bool = False
    remove_names: bool = False
    remove_citations: bool = True


@dataclass(frozen=True)
class ExtractConfig:
    context_chars: int = 50           # entity context on each side
    pair_context_chars: int = 20      # relationship context on each side
    max_pair_gap: int = 200           # e2.start - e1.end must not exceed this
    min_confidence: float = 0.7       # relationships kept when score is strictly above
    range_bucket: int = 256           # bucket width (chars) of the pair range join
    broadcast_max_bytes: int = 64 << 20  # gazetteer bytes allowed in a broadcast
    inline_firsts: int = 50_000       # first tokens of phrases that are tested inside the scan
    # Tokenize articles in chunks of this many characters (cut after whitespace)
    # so one huge article spreads over many tasks; None = one window per article.
    chunk_chars: int | None = None


@dataclass(frozen=True)
class PipelineConfig:
    mode: str = CORRECTED
    pages: PageConfig = field(default_factory=PageConfig)
    clean: CleanConfig = field(default_factory=CleanConfig)
    extract: ExtractConfig = field(default_factory=ExtractConfig)
    default_date: str | None = None   # None = today's date
