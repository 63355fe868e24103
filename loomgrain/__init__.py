"""Loomgrain: corpus curation and grounded question/answer data on Spark."""

import importlib

__version__ = "0.2.0"

#: Public names by the module that has them; modules load when a name is first used.
_WHERE = {
    "Curation": "plans.curation",
    "CurationConfig": "plans.config",
    "HttpGenerator": "sources.model",
    "Progress": "plans.progress",
    "Reply": "sources.model",
    "StateStore": "sources.state",
    "build_context": "functions.text",
    "build_session": "session",
    "check_pairs": "operators.grounding",
    "evaluate": "plans.evaluate",
    "load_curation_config": "plans.config",
    "load_stage_config": "plans.config",
    "parse_tolerant": "functions.jsonx",
    "prepare": "plans.corpus",
    "select_papers": "operators.selection",
}
__all__ = sorted(_WHERE)


def __getattr__(name: str):
    if name not in _WHERE:
        raise AttributeError(name)
    return getattr(importlib.import_module(f"{__name__}.{_WHERE[name]}"), name)
