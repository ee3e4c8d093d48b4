"""Settings of a run. Values are those of the public metropolitan configuration."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields, replace


@dataclass(frozen=True)
class Config:
    """Bounding box, model constants and employment bands."""

    bbox: tuple[float, float, float, float] = (-59.4, -35.2, -57.7, -34.2)
    gravity_decay_km: float = 12.0
    candidate_origins: int = 400
    projection_capacity_multiplier: float = 16.0
    projection_flow_quantum: int = 15
    maximum_population_size: int = 200
    maximum_population_count: int = 100_000
    solver_zone_degrees: float = 0.02
    display_cluster_count: int = 6000
    ipf_tolerance: float = 1.0
    ipf_max_iterations: int = 2000
    year: int = 2022
    grid_degrees: float = 0.005
    employment_weights: dict[str, float] = field(
        default_factory=lambda: {"a. 1-9": 5.0, "b. 10-49": 29.5, "c. 50-199": 124.5, "d. 200-499": 349.5, "e. 500+": 500.0}
    )

    def __post_init__(self) -> None:
        west, south, east, north = self.bbox
        if not (west < east and south < north):
            raise ValueError("bbox must be west < east and south < north")

    @classmethod
    def read(cls, path: str) -> Config:
        """From a JSON file with the groups ``demand`` and ``workplaces``; unknown names are ignored."""
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        flat = said | said.get("demand", {}) | said.get("workplaces", {})
        known = {x.name for x in fields(cls)}
        flat = {k: tuple(v) if k == "bbox" else v for k, v in flat.items() if k in known}
        return cls(**flat)

    def with_environment(self) -> Config:
        """Overrides GRAVITA_<NAME> from the environment, for numbers."""
        found = {x.name: os.environ.get(f"GRAVITA_{x.name.upper()}") for x in fields(self)}
        return replace(self, **{k: type(getattr(self, k))(v) for k, v in found.items() if v and isinstance(getattr(self, k), int | float)})
