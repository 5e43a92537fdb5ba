"""Pipeline configurations: a declared schema of keys and defaults, and one reader for all of its sections.

A section of a configuration becomes a Section, whose keys are its attributes. Keys that steer worker pools are known, so
that configurations with them can be read, and come back in `unused`: they have no effect on Spark.
"""

from __future__ import annotations

import copy
from typing import Any

import yaml

#: The default of a key that must be given.
NEEDED = object()

_OPERATOR = {"name": NEEDED, "params": {}, "enabled": True}
_STAGE = {"name": NEEDED, "operators": [_OPERATOR], "worker": {"num_replicas": None, "min_replicas": None, "max_replicas": None, "resources": {}}, "output_path": None}
#: Keys and defaults of a configuration as files have them: a mapping with keys is a section, a list of one section repeats
#: it, and an empty mapping takes any keys.
SCHEMA: dict[str, Any] = {
    "data_loader": {"type": NEEDED, "params": {}, "checkpoint_path": None, "checkpoint_files": 100},
    "stages": [_STAGE],
    "data_writer": {"type": None, "params": {}},
    "executor": {
        "max_samples": None,
        "batch_size": 100,
        "rejected_samples": {"enabled": False, "output_path": None, "writer_type": None},
        "metrics": {"enabled": True, "output_path": "./output/metrics", "write_on_completion": True, "generate_report": False, "debug_samples_per_operator": 20, "profile": False},
    },
}
#: Keys without effect, by the path of their section.
UNUSED = {
    "data_loader": {"num_workers", "checkpoint_interval"},
    "executor": {"use_ray", "num_cpus", "dedup_num_buckets", "max_in_flight"},
    "executor.metrics": {"collect_custom_metrics", "huggingface_repo", "huggingface_token"},
}


class Section(dict):
    """A mapping with its keys as attributes; unused: given keys without effect."""

    def __init__(self, values: dict[str, Any], unused: dict[str, Any] | None = None):
        super().__init__(values)
        object.__setattr__(self, "unused", unused or {})

    def __getattr__(self, key: str) -> Any:
        try:
            return self[key]
        except KeyError:
            raise AttributeError(key) from None

    def __setattr__(self, key: str, value: Any) -> None:
        self[key] = value


def read(body: dict | None, schema: dict[str, Any], at: str = "") -> Section:
    """body by schema, with defaults; unknown keys and missing ones are errors that name their place."""
    body = dict(body or {})
    unused = {k: body.pop(k) for k in UNUSED.get(at, set()) & body.keys()}
    if strange := body.keys() - schema.keys():
        raise ValueError(f"unknown keys in {at or 'the configuration'}: {', '.join(sorted(strange))}")
    out = {}
    for key, default in schema.items():
        place, given = f"{at}.{key}".lstrip("."), body.get(key)
        if isinstance(default, list):
            out[key] = [read(x, default[0], f"{place}[]") for x in given or []]
        elif isinstance(default, dict) and default:
            out[key] = read(given, default, place)
        elif default is NEEDED and given is None:
            raise ValueError(f"{place} is needed")
        else:
            out[key] = given if key in body and given is not None else copy.deepcopy(default)
    return Section(out, unused)


def replicas(worker: dict[str, Any]) -> tuple[int, int]:
    """The least and the largest number of replicas: num_replicas stands for what is not given of the two, else 1."""
    count, least, most = (worker.get(k) for k in ("num_replicas", "min_replicas", "max_replicas"))
    least = least if least is not None else 1 if count is None else count
    most = most if most is not None else least if count is None else count
    if least < 1 or most < least:
        raise ValueError(f"replicas from {least} to {most}: the first must be 1 or more, the second no less")
    return least, most


def _by_pools(body: dict) -> list[dict]:
    """Stages of the older form: a list of operators, and workers that name theirs."""
    named = {op["name"]: op for op in body["operators"]}
    out = []
    for pool in body["workers"]:
        worker = {k: pool[k] for k in ("resources", "num_replicas") if k in pool}
        out.append({"name": pool["name"], "operators": [named[n] for n in pool["operator_names"] if n in named], "worker": worker})
    return out


def configuration(body: dict) -> Section:
    """The checked configuration of a pipeline from a plain mapping."""
    body = dict(body)
    pools = {k: body.pop(k) for k in ("operators", "workers") if k in body}
    if body.get("stages") is None and len(pools) == 2:
        body["stages"] = _by_pools(pools)
    config = read(body, SCHEMA)
    for stage in config.stages:
        stage.worker.min_replicas, stage.worker.max_replicas = replicas(stage.worker)
    return config


def from_yaml(path: str) -> Section:
    with open(path) as file:
        return configuration(yaml.safe_load(file))
