"""Mixture files: reading, roots, environment variables, and where a dataset lies."""

from __future__ import annotations

import os
from pathlib import Path


def load_config(path: str) -> dict:
    """A YAML or JSON mapping. YAML needs the yaml package; a small subset (nested mappings of scalars) is read without it."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        import json

        out = json.loads(text)
    else:
        try:
            import yaml

            out = yaml.safe_load(text)
        except ModuleNotFoundError:
            out = plain_yaml(text)
    if not isinstance(out, dict):
        raise ValueError(f"{path} isn't a mapping")
    return out


def plain_yaml(text: str) -> dict:
    """Nested mappings of scalars by indentation; comments and blank lines are skipped."""
    root: dict = {}
    stack: list[tuple[int, dict]] = [(-1, root)]
    for number, raw in enumerate(text.splitlines(), 1):
        line = raw.split(" #")[0].rstrip()
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        indent = len(line) - len(line.lstrip())
        key, colon, value = line.strip().partition(":")
        if not colon:
            raise ValueError(f"line {number} isn't 'key: value'")
        while indent <= stack[-1][0]:
            stack.pop()
        key, value = key.strip("'\""), value.strip()
        if value:
            stack[-1][1][key] = scalar(value)
        else:
            stack[-1][1][key] = child = {}
            stack.append((indent, child))
    return root


def scalar(value: str) -> object:
    if value[:1] in "'\"" and value[-1:] == value[:1]:
        return value[1:-1]
    low = value.lower()
    if low in ("null", "~"):
        return None
    if low in ("true", "false"):
        return low == "true"
    for kind in (int, float):
        try:
            return kind(value)
        except ValueError:
            pass
    return value


def data_root(config: dict, base: str) -> str:
    """The folder of a mixture's data: `root`, with environment variables, below `base` where it is relative."""
    root = os.path.expandvars(str(config.get("root") or ""))
    return root if os.path.isabs(root) else os.path.normpath(os.path.join(base, root))


def dataset_path(root: str, name: str, entry: dict) -> str:
    """Where a dataset lies: its own `path`, else root/name, else root/name.jsonl; FileNotFoundError for none."""
    if own := entry.get("path"):
        own = os.path.expandvars(str(own))
        return own if os.path.isabs(own) else os.path.join(root, own)
    for candidate in (os.path.join(root, name), os.path.join(root, f"{name}.jsonl")):
        if os.path.exists(candidate):
            return candidate
    raise FileNotFoundError(f"{name}: neither {root}/{name} nor {root}/{name}.jsonl")


def split_paths(paths: list[str]) -> list[str]:
    """Data paths without their `#N` limits; FileNotFoundError for one that doesn't exist."""
    bare = [p.split("#")[0] for p in paths]
    for p in bare:
        if not os.path.exists(p):
            raise FileNotFoundError(p)
    return bare
