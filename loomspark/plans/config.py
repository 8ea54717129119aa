"""The build's configuration, validated as a whole: every fault is told at once."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import fields
from pathlib import Path

import yaml

from ..functions.exprs import CENSORED_POLICIES, MINUTES
from ..operators.derive import Settings

SECTIONS = {"seed": int, "site": str, "sites": dict, "sources": dict, "catalog": dict, "build": dict, "cleaning": dict, "mapping": dict, "features": dict, "certificates": dict, "output": str, "vocabulary": str}
REQUIRED = ("site", "sites", "output")
_VARIABLE = re.compile(r"\$\{(\w+)\}")


def expanded(value, env: Mapping[str, str], faults: list[str], where: str = ""):
    """${NAME} replaced throughout; unset names are faults."""
    if isinstance(value, str):
        for name in _VARIABLE.findall(value):
            if name not in env:
                faults.append(f"{where}: ${{{name}}} isn't set")
        return _VARIABLE.sub(lambda m: env.get(m[1], m[0]), value)
    if isinstance(value, dict):
        return {k: expanded(v, env, faults, f"{where}.{k}".lstrip(".")) for k, v in value.items()}
    if isinstance(value, list):
        return [expanded(v, env, faults, f"{where}[{i}]") for i, v in enumerate(value)]
    return value


def validated(raw: dict, env: Mapping[str, str] = os.environ) -> dict:
    faults: list[str] = []
    config = expanded(raw, env, faults)
    for key, value in config.items():
        if key not in SECTIONS:
            faults.append(f"unknown section {key}")
        elif value is not None and not isinstance(value, SECTIONS[key]):
            faults.append(f"{key} must be {SECTIONS[key].__name__}")
    faults += [f"{k} is required" for k in REQUIRED if not config.get(k)]
    sites = config.get("sites") if isinstance(config.get("sites"), dict) else {}
    if sites and config.get("site") not in sites:
        faults.append(f"site {config.get('site')!r} is none of {', '.join(sites)}")
    cleaning = config.get("cleaning") or {}
    if cleaning.get("censored", "limit") not in CENSORED_POLICIES:
        faults.append(f"cleaning.censored must be one of {', '.join(CENSORED_POLICIES)}")
    if cleaning.get("duration_unit", "minutes") not in MINUTES:
        faults.append(f"cleaning.duration_unit must be one of {', '.join(MINUTES)}")
    known = {f.name for f in fields(Settings)}
    features = config.get("features") or {}
    faults += [f"features.{k} is unknown" for k in features if k not in known]
    for a, b in (("cpdl_low", "cpdl_high"), ("lactate_low", "lactate_high"), ("cd4_low", "cd4_high")):
        if a in features and b in features and features[a] > features[b]:
            faults.append(f"features.{a} is above features.{b}")
    threshold = (config.get("build") or {}).get("correlation_threshold", 0.9)
    if not isinstance(threshold, (int, float)) or not 0 < threshold <= 1:
        faults.append("build.correlation_threshold must lie in (0, 1]")
    if faults:
        raise ValueError("config: " + "; ".join(faults))
    return config


def load(path: str | Path, env: Mapping[str, str] = os.environ) -> dict:
    return validated(yaml.safe_load(Path(path).read_text()) or {}, env)


def settings(config: dict) -> Settings:
    found = dict(config.get("features") or {})
    if isinstance(found.get("impurity_spec_limits"), list):
        found["impurity_spec_limits"] = tuple(found["impurity_spec_limits"])
    return Settings(**found)
