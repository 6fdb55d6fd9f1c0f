"""Where sources are read from and where layers are written to."""

from __future__ import annotations

import os
from dataclasses import dataclass

TARGET_ENV = "STRATUM_TARGET"
LAYERS = ("bronze", "silver_staging", "silver_intermediate", "gold")


@dataclass(frozen=True)
class PipelineConfig:
    """``source_base``: raw parquet (``{source_base}/{namespace}/{table}``);
    ``target_base``: one folder per layer (``{target_base}/{layer}/{model}``);
    ``seeds_dir``: seed CSV files.  The two bases are independent, so a dev
    target can read production sources."""
    source_base: str
    target_base: str
    seeds_dir: str | None = None
    name: str = "dev"

    def source_path(self, namespace: str, table: str) -> str:
        return f"{self.source_base.rstrip('/')}/{namespace}/{table}"

    def model_path(self, layer: str, model: str) -> str:
        return f"{self.target_base.rstrip('/')}/{layer}/{model}"

    def report_path(self, name: str) -> str:
        return f"{self.target_base.rstrip('/')}/_reports/{name}"


def resolve_target(targets: dict[str, PipelineConfig], name: str | None = None) -> PipelineConfig:
    """Pick a configuration by name (default: ``$STRATUM_TARGET`` or ``dev``);
    an unknown name is rejected."""
    name = name or os.environ.get(TARGET_ENV, "dev")
    if name not in targets:
        raise ValueError(f"Unknown target: {name!r}. Must be one of: {sorted(targets)}")
    return targets[name]
