"""Configuration: a YAML file, the environment, defaults."""

from __future__ import annotations

import os
from pathlib import Path
from typing import Any


def load_config(path: str | None) -> dict[str, Any]:
    """{} for a missing or empty file. JSON is read where no YAML library is
    installed."""
    if not path or not Path(path).exists():
        return {}
    text = Path(path).read_text(encoding="utf-8")
    try:
        import yaml

        return yaml.safe_load(text) or {}
    except ImportError:
        import json

        return json.loads(text) if text.strip() else {}


def setting(config: dict[str, Any], key: str, variable: str, default: Any) -> Any:
    """Config, else environment, else default; empty and zero fall through."""
    return config.get(key) or os.environ.get(variable) or default


def budget(config: dict[str, Any], key: str, default: Any) -> Any:
    """Config unless it is None, else default; zero counts."""
    value = config.get(key)
    return default if value is None else value


def load_env(path: str = ".env") -> None:
    """KEY=VALUE lines of a file into the environment, where not yet set."""
    if Path(path).exists():
        for line in Path(path).read_text(encoding="utf-8").splitlines():
            key, found, value = line.strip().removeprefix("export ").partition("=")
            if found and key and not key.startswith("#"):
                os.environ.setdefault(key.strip(), value.strip().strip("'\""))


def model_settings(config: dict[str, Any]) -> dict[str, Any]:
    """What a model loader needs: names and device from the configuration, the
    environment or a default, in this order; memory budgets in GiB."""
    model = config.get("vlm") or {}
    return {
        "model": setting(model, "model", "VLM_MODEL", ""), "device": setting(model, "device", "VLM_DEVICE", "cpu"), "token": setting(model, "token", "HF_TOKEN", None),
        "max_new_tokens": int(setting(model, "max_new_tokens", "VLM_MAX_NEW_TOKENS", 4096)), "gpu_gib": budget(model, "gpu_memory_gib", 5), "cpu_gib": budget(model, "cpu_memory_gib", 32),
    }
