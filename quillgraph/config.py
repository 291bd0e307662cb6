"""Settings of generation, evaluation and the chat model, checked where they are made."""

from __future__ import annotations

from dataclasses import dataclass, field

MODES = ("single-doc", "cross-doc", "sog-lite", "long-context", "longfaith-qa", "both", "all")
ENTITY_STRATEGIES = ("llm-order", "importance", "rarity", "hybrid")
PATH_STRATEGIES = ("dfs", "bridge", "coverage")


def _require(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


@dataclass(frozen=True)
class ChatConfig:
    """Where and how the chat model is called. The key isn't shown."""

    provider: str = "local"
    model: str = "meta-llama/Llama-3.1-8B-Instruct"
    base_url: str | None = None
    api_key: str | None = field(default=None, repr=False)
    api_key_env: str | None = None
    timeout: float = 120.0
    max_retries: int = 4
    backoff: float = 1.5


@dataclass(frozen=True)
class GenerateConfig:
    mode: str = "single-doc"
    text_key: str = "text"
    title_key: str | None = "title"
    id_key: str | None = None
    max_docs: int | None = None
    min_entity_chars: int = 2
    max_entities: int = 60
    entity_strategy: str = "llm-order"
    combo_sizes: tuple[int, ...] = (2, 3)
    max_combos: int | None = None
    sample_combos: bool = False
    seed: int = 13
    min_shared: int = 1
    max_shared: int = 12
    max_pairs: int | None = None
    sample_pairs: bool = False
    max_section_chars: int = 1800
    path_length: int = 3
    max_paths: int | None = 1000
    path_strategy: str = "dfs"
    candidate_multiplier: int = 8
    path_min_shared: int = 0
    group_size: int = 3
    group_max_chars: int = 6000
    group_max_examples: int | None = 100
    styles: tuple[str, ...] = ("default",)
    include_source_text: bool = False
    resume: bool = True
    workers: int = 8
    max_in_flight: int | None = None
    entity_temperature: float = 0.0
    relation_temperature: float = 1.0
    entity_max_tokens: int | None = 2048
    relation_max_tokens: int | None = 2048
    json_mode: bool = False
    metadata: tuple[tuple[str, str], ...] = ()

    def __post_init__(self) -> None:
        from .operators.prompts import STYLES

        _require(self.mode in MODES, f"unknown mode {self.mode}")
        _require(self.entity_strategy in ENTITY_STRATEGIES, f"unknown entity strategy {self.entity_strategy}")
        _require(self.path_strategy in PATH_STRATEGIES, f"unknown path strategy {self.path_strategy}")
        _require(bool(self.combo_sizes) and all(k > 0 for k in self.combo_sizes), "combo sizes must be positive")
        _require(bool(self.styles) and set(self.styles) <= set(STYLES), f"unknown style among {self.styles}")
        _require(self.path_length >= 1 and self.group_size >= 1, "path length and group size must be positive")
        _require(self.workers >= 1 and (self.max_in_flight is None or self.max_in_flight >= 1), "workers and calls in flight must be positive")
        _require(self.candidate_multiplier >= 1, "the candidate multiplier must be positive")


@dataclass(frozen=True)
class EvaluateConfig:
    text_key: str = "text"
    title_key: str | None = "title"
    id_key: str | None = None
    min_overall: float = 0.75
    min_support: float = 0.95
    min_mention: float = 0.8
    max_unsupported: int = 2
    max_overlap: float = 0.65
    ngram: int = 5
