"""Tunable settings, all in one frozen dataclass."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    # similarity and grouping
    match_similarity: float = 0.85      # nearest canonical must be strictly above
    fuzzy_ratio: float = 0.85           # Levenshtein ratio at or above
    cluster_distance: float = 0.3       # cosine distance strictly below
    min_cluster_size: int = 3
    parent_similarity: float = 0.5      # at or above
    synonyms: dict[str, str] = field(default_factory=dict)
    negators: tuple[str, ...] = ("not", "no", "never", "none", "cannot")

    # drift and contradiction
    drift_conviction: float = 0.15
    drift_frequency: int = 2
    opposition: float = 0.7
    ambiguous_from: float = 0.5

    # extraction and calls
    batch_size: int = 10
    max_retries: int = 3
    backoff_base: int = 2
    backoff_cap_s: int = 60
    budget_window_s: int = 60
    budget_requests: int = 3500
    budget_tokens: int = 90000
    usd_per_1k_tokens: float = 0.045

    # reports and snapshots
    report_every: int = 10
    retention_days: int = 30
    max_columns: int = 200              # columns of one block of the matrix export; there are as many blocks as it takes
    csv_rows: int = 100_000             # about so many lines in one file of a block
    page_size: int = 1000               # longest array in one output row

    # choice of sampled rows
    seed: int = 17


DEFAULT = Params()
