"""The published datasets as specifications (see ``spec``), looked up by name."""

from __future__ import annotations

from geoindicators.datasets.spec import DatasetSpec, run, run_all


def registry() -> dict[str, DatasetSpec]:
    from geoindicators.datasets import composite, households, simple
    return {s.name: s for s in [*simple.SPECS, *households.SPECS, *composite.SPECS]}


def get(name: str) -> DatasetSpec:
    reg = registry()
    if name not in reg:
        raise ValueError(f"Unknown dataset: {name!r}")
    return reg[name]


__all__ = ["DatasetSpec", "get", "registry", "run", "run_all"]
