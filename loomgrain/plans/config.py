"""Stage and pipeline configuration: checked mappings and a frozen record. Driver-side only."""

from __future__ import annotations

import dataclasses
from pathlib import Path
from typing import Any

SECTIONS = ("model", "data", "train", "output")


def read_yaml(path: str | Path) -> Any:
    import yaml

    p = Path(path)
    if not p.exists():
        raise FileNotFoundError(f"no configuration file {p}")
    return yaml.safe_load(p.read_text(encoding="utf-8"))


def load_stage_config(path: str | Path, sections: tuple[str, ...] = SECTIONS) -> dict[str, dict]:
    """A stage's configuration; names the section that is missing or is not a mapping."""
    raw = read_yaml(path)
    if not isinstance(raw, dict):
        raise ValueError(f"{path}: the top level must be a mapping")
    for name in sections:
        if name not in raw:
            raise KeyError(f"{path}: section '{name}' is missing")
        if not isinstance(raw[name], dict):
            raise TypeError(f"{path}: section '{name}' must be a mapping")
    return raw


@dataclasses.dataclass(frozen=True)
class CurationConfig:
    """What the curation pipeline needs; one field for each configured value."""

    store: str
    source_db: str
    state_db: str
    export_file: str
    base_url: str
    model: str
    concurrency: int
    select_n: int
    select_seed: int
    workers: int
    abstract_chars: int
    methods_chars: int
    results_chars: int
    pairs_per_paper: int
    generate_temperature: float
    generate_max_tokens: int
    generate_chunk: int
    judge_temperature: float
    judge_max_tokens: int
    judge_chunk: int
    require_judge: bool
    limit: int | None = None


#: Field of the record: (section, key) of the file.
_PLACES = {
    "store": ("paths", "store"),
    "source_db": ("paths", "source_db"),
    "state_db": ("paths", "state_db"),
    "export_file": ("paths", "export_file"),
    "base_url": ("model", "base_url"),
    "model": ("model", "name"),
    "concurrency": ("model", "concurrency"),
    "select_n": ("select", "n"),
    "select_seed": ("select", "seed"),
    "workers": ("sections", "workers"),
    "abstract_chars": ("sections", "abstract_chars"),
    "methods_chars": ("sections", "methods_chars"),
    "results_chars": ("sections", "results_chars"),
    "pairs_per_paper": ("generate", "pairs_per_paper"),
    "generate_temperature": ("generate", "temperature"),
    "generate_max_tokens": ("generate", "max_tokens"),
    "generate_chunk": ("generate", "chunk"),
    "judge_temperature": ("judge", "temperature"),
    "judge_max_tokens": ("judge", "max_tokens"),
    "judge_chunk": ("judge", "chunk"),
    "require_judge": ("export", "require_judge"),
}
OVERRIDABLE = ("store", "source_db", "state_db", "export_file", "base_url", "model", "concurrency", "limit")


def load_curation_config(path: str | Path, overrides: dict[str, Any] | None = None) -> CurationConfig:
    """The record of a file; overrides that are not None replace the overridable fields."""
    raw = read_yaml(path)
    values = {field: raw[section][key] for field, (section, key) in _PLACES.items()}
    values |= {k: v for k, v in (overrides or {}).items() if k in OVERRIDABLE and v is not None}
    return CurationConfig(**values)


def infer_stage(config: dict[str, dict]) -> str:
    """sft if the data section has a training file, dapt if it has a corpus folder."""
    data = config.get("data", {})
    if data.get("train_file"):
        return "sft"
    if data.get("corpus_dir"):
        return "dapt"
    raise ValueError("data has neither train_file nor corpus_dir")
