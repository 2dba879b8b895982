"""Run configuration, checked before any plan is built."""

from __future__ import annotations

from dataclasses import dataclass, fields
from typing import Any

FLATFIELD_MODES = ("POLY", "MEAN")
REGISTRATION_MODES = ("CROSS",)
PLACES = ("manifest", "manifest_well", "manifest_registration", "image_dir", "publish_dir")


@dataclass(frozen=True)
class RunConfig:
    """Parameters of a run; unknown names and impossible combinations are errors."""

    manifest: str
    blacklist: str | None = None
    control_list: str | None = None
    manifest_well: str | None = None
    manifest_registration: str | None = None
    image_dir: str | None = None
    publish_dir: str = "../results"
    max_project: bool = False
    manual_scale: str | None = None
    scale_slope: str | None = None
    scale_bias: str | None = None
    autoscale: bool = False
    autoscale_q1: str = "q99.9999"
    autoscale_q2: float = 95.0
    dummy_mode: bool = False
    threshold: bool = False
    flatfield: bool = True
    flatfield_mode: str = "POLY"
    flatfield_degree: int = 4
    flatfield_global: bool = False
    n_images: int = 200
    n_images_test: int = 100
    registration_mode: str = "CROSS"
    registration_eval: bool = True
    cell_size: float = 75.0
    nucleus_size: float = 60.0
    least_cell_area: float | None = None
    least_nucleus_area: float | None = None
    downsample: int | None = None
    psf_rounds: int = 100
    clip_max: float = 327_675.0
    most_per_field: int = 1_000
    pipeline: tuple[dict, ...] = ()

    def __post_init__(self) -> None:
        problems = []
        if not self.manifest:
            problems.append("manifest is required")
        if self.manual_scale and self.autoscale:
            problems.append("manual_scale and autoscale exclude each other")
        if self.control_list and not self.autoscale:
            problems.append("a control list needs autoscale")
        if self.dummy_mode and not self.control_list:
            problems.append("dummy_mode needs a control list")
        if (self.scale_slope is None) != (self.scale_bias is None):
            problems.append("scale_slope and scale_bias go together")
        if not 0 <= self.autoscale_q2 <= 100:
            problems.append("autoscale_q2 is a percentage")
        if self.flatfield_mode not in FLATFIELD_MODES:
            problems.append(f"flatfield_mode is one of {', '.join(FLATFIELD_MODES)}")
        if self.registration_mode not in REGISTRATION_MODES:
            problems.append(f"registration_mode is one of {', '.join(REGISTRATION_MODES)}")
        if self.flatfield_global and not self.manifest_registration:
            problems.append("flatfield_global needs a registration manifest")
        if min(self.cell_size, self.nucleus_size, self.clip_max) <= 0 or self.n_images < 1 or self.most_per_field < 1:
            problems.append("sizes and counts are positive")
        if problems:
            raise ValueError("; ".join(problems))

    def only(self, *read: str) -> None:
        """Raises where a parameter that a plan does not read has been set: it would do nothing.

        Names of files and folders are those of tables that plans are given, and pass.
        """
        unread = [f.name for f in fields(self) if f.name not in (*PLACES, *read) and getattr(self, f.name) != f.default]
        if unread:
            raise ValueError(f"no effect on this plan: {', '.join(unread)}")

    @classmethod
    def of(cls, given: dict[str, Any]) -> RunConfig:
        known = {f.name for f in fields(cls)}
        if unknown := sorted(set(given) - known):
            raise ValueError(f"unknown parameters: {', '.join(unknown)}")
        return cls(**given)
