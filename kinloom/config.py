"""Settings of the linkage plan. Unknown keys and values out of range are errors.

Names and defaults of settings are fixed values."""

from __future__ import annotations

import dataclasses
import math
from dataclasses import dataclass, field


def _from_dict(kind: type, given: dict):  # noqa: ANN202
    unknown = set(given) - {f.name for f in dataclasses.fields(kind)}
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return kind(**given)


def _positive(own: object, *names: str) -> None:
    for name in names:
        value = getattr(own, name)
        if isinstance(value, bool) or not isinstance(value, int) or value < 1:
            raise ValueError(f"{name} must be a positive integer")


def _thresholds(values: tuple[float, ...]) -> None:
    given = list(values)
    if not given or any(not math.isfinite(t) or not 0 <= t <= 1 for t in given) or given != sorted(set(given)):
        raise ValueError("thresholds must be finite, in [0, 1], sorted and unique")


@dataclass(frozen=True)
class PrepConfig:
    """Candidate generation and splits."""

    hash_bits: int = 18
    validation_fraction: float = 0.2
    seed: int = 42
    block_limit: int = 100
    lexical_pool: int = 120
    lexical_top_k: int = 25
    max_candidates: int = 80
    query_terms: int = 16
    india_retrieval_multiplier: int = 1
    word_retrieval: int = 1
    diverse_candidates: int = 8
    #: Order of full-text pools and of overflowed blocks before their cut: by record number or by score.
    lexical_order: str = "rowid"
    #: hash: by query; cluster: by connected component of shared references.
    split_strategy: str = "hash"

    def __post_init__(self) -> None:
        _positive(self, "block_limit", "lexical_pool", "lexical_top_k", "max_candidates", "query_terms", "india_retrieval_multiplier", "diverse_candidates")
        if not 12 <= self.hash_bits <= 22:
            raise ValueError("hash_bits must lie in [12, 22]")
        if not 0 < self.validation_fraction < 1:
            raise ValueError("validation_fraction must lie in (0, 1)")
        if self.lexical_top_k > self.lexical_pool:
            raise ValueError("lexical_top_k must not exceed lexical_pool")
        if self.lexical_order not in ("rowid", "bm25"):
            raise ValueError("lexical_order is rowid or bm25")
        if self.split_strategy not in ("hash", "cluster"):
            raise ValueError("split_strategy is hash or cluster")

    @classmethod
    def from_dict(cls, given: dict) -> PrepConfig:
        return _from_dict(cls, given)


@dataclass(frozen=True)
class DenseConfig:
    """Nearest neighbours over embeddings."""

    nlist: int = 1024
    nprobe: int = 32
    ann_top_k: int = 32
    ann_shortlist: int = 128
    ann_training_rows: int = 100_000
    #: Bytes of a compressed vector; must divide the dimension.
    pq_m: int = 32
    #: Partitions below this many references are searched exactly.
    exact_below: int = 10_000
    seed: int = 42

    def __post_init__(self) -> None:
        _positive(self, "nlist", "nprobe", "ann_top_k", "ann_shortlist", "ann_training_rows", "pq_m")
        if self.ann_top_k > self.ann_shortlist:
            raise ValueError("ann_top_k must not exceed ann_shortlist")

    @classmethod
    def from_dict(cls, given: dict) -> DenseConfig:
        return _from_dict(cls, given)


@dataclass(frozen=True)
class MatcherConfig:
    """Gradient-boosted trees and the threshold sweep."""

    max_iter: int = 60
    max_depth: int = 5
    max_bins: int = 64
    step_size: float = 0.1
    min_instances: int = 20
    feature_subset: str = "0.9"
    seed: int = 42
    #: None: every labelled pair; else a uniform sample of so many.
    max_training_rows: int | None = None
    thresholds: tuple[float, ...] = field(default_factory=lambda: tuple(round(0.05 * k, 2) for k in range(1, 20)))

    def __post_init__(self) -> None:
        _positive(self, "max_iter", "max_depth", "max_bins", "min_instances")
        _thresholds(self.thresholds)

    @classmethod
    def from_dict(cls, given: dict) -> MatcherConfig:
        return _from_dict(cls, {**given, **({"thresholds": tuple(given["thresholds"])} if "thresholds" in given else {})})


@dataclass(frozen=True)
class BoostingConfig:
    """Leaf-wise gradient boosting with early stopping."""

    # Names and defaults of these settings are fixed values.
    num_boost_round: int = 600
    early_stopping_rounds: int = 50
    learning_rate: float = 0.05
    num_leaves: int = 31
    min_data_in_leaf: int = 50
    max_bin: int = 63
    feature_fraction: float = 0.9
    bagging_fraction: float = 0.9
    bagging_freq: int = 1
    lambda_l2: float = 2.0
    seed: int = 42
    #: Uniform samples of so many pairs of either split; None: all.
    max_train_pairs: int | None = None
    max_early_stopping_pairs: int | None = None
    thresholds: tuple[float, ...] = field(default_factory=lambda: tuple(round(0.05 * k, 2) for k in range(1, 20)))

    def __post_init__(self) -> None:
        _positive(self, "num_boost_round", "early_stopping_rounds", "num_leaves", "min_data_in_leaf", "max_bin", *[n for n in ("max_train_pairs", "max_early_stopping_pairs") if getattr(self, n) is not None])
        if self.num_leaves < 2 or self.max_bin > 254:
            raise ValueError("num_leaves must be at least 2, max_bin at most 254")
        for name in ("feature_fraction", "bagging_fraction", "learning_rate"):
            if not 0 < getattr(self, name) <= 1:
                raise ValueError(f"{name} must lie in (0, 1]")
        if isinstance(self.bagging_freq, bool) or not isinstance(self.bagging_freq, int) or self.bagging_freq < 0 or not self.lambda_l2 >= 0:
            raise ValueError("bagging_freq and lambda_l2 must not be negative")
        _thresholds(self.thresholds)

    @classmethod
    def from_dict(cls, given: dict) -> BoostingConfig:
        return _from_dict(cls, {**given, **({"thresholds": tuple(given["thresholds"])} if "thresholds" in given else {})})
