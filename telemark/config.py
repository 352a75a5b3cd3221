"""Thresholds of every operator, with TOML overrides."""

from __future__ import annotations

import dataclasses
import tomllib
from dataclasses import dataclass, field
from pathlib import Path


def _require(condition: bool, message: str) -> None:
    if not condition:
        raise ValueError(message)


# The defaults below are fixed values of the analysis contract.


@dataclass(frozen=True)
class TimestampQuality:
    duplicate_epsilon_ms: float = 0.05
    normal_period_tolerance_ratio: float = 0.20
    gap_warning_factor: float = 2.2
    gap_fail_factor: float = 5.0
    image_gap_floor_ms: float = 70.0
    state_gap_floor_ms: float = 45.0
    action_gap_floor_ms: float = 120.0
    log_publish_latency_warning_ms: float = 100.0


@dataclass(frozen=True)
class CrossStream:
    target_fps: float = 20
    max_image_residual_ms: float = 40.0
    max_state_residual_ms: float = 20.0
    max_action_residual_ms: float = 60.0
    max_start_end_skew_ms: float = 500.0


@dataclass(frozen=True)
class JointMotionQuality:
    max_state_step_deg: float = 15.0
    max_action_step_deg: float = 25.0
    max_state_velocity_deg_s: float = 300.0
    max_action_velocity_deg_s: float = 500.0
    max_acceleration_deg_s2: float = 5000.0
    max_tracking_p95_deg: float = 10.0


@dataclass(frozen=True)
class ImageQuality:
    decode_samples_per_topic: int = 12
    hash_samples_per_topic: int = 40
    max_sampled_identical_ratio: float = 0.20


@dataclass(frozen=True)
class HeadTimestamp:
    topic: str = "/camera/head/color/image_raw/compressed"
    nominal_period_ms: float = 0.0
    period_search_min_ms: float = 25.0
    period_search_max_ms: float = 50.0
    normal_step_tolerance_ratio: float = 0.20
    anchor_residual_tolerance_periods: float = 0.35
    local_anchor_tolerance_ratio: float = 0.30
    short_run_max_frames: int = 6
    warning_correction_periods: float = 1.0
    high_risk_correction_periods: float = 2.0
    minimum_anchor_count: int = 20


@dataclass(frozen=True)
class Conversion:
    fps: float = 20
    max_image_delta_ms: float = 40.0
    max_state_delta_ms: float = 20.0
    max_action_delta_ms: float = 60.0
    max_action_step_deg: float = 25.0
    gripper_scale: float = 100.0


@dataclass(frozen=True)
class PipelineConfig:
    timestamp: TimestampQuality = field(default_factory=TimestampQuality)
    cross_stream: CrossStream = field(default_factory=CrossStream)
    joint_motion: JointMotionQuality = field(default_factory=JointMotionQuality)
    image: ImageQuality = field(default_factory=ImageQuality)
    head_timestamp: HeadTimestamp = field(default_factory=HeadTimestamp)
    conversion: Conversion = field(default_factory=Conversion)

    def __post_init__(self):
        timing, cleaning = self.timestamp, self.head_timestamp
        _require(self.cross_stream.target_fps > 0 and self.conversion.fps > 0, "frame rates must be positive")
        _require(0 < timing.normal_period_tolerance_ratio < 1, "the period tolerance must lie between 0 and 1")
        _require(timing.gap_warning_factor > 1, "gap_warning_factor must be above 1")
        _require(timing.gap_fail_factor > timing.gap_warning_factor, "gap_fail_factor must be above the warning factor")
        _require(
            0 < cleaning.period_search_min_ms < cleaning.period_search_max_ms, "the period search range is empty"
        )
        _require(
            cleaning.short_run_max_frames >= 1 and cleaning.minimum_anchor_count >= 2, "run or anchor count too low"
        )
        _require(
            cleaning.high_risk_correction_periods >= cleaning.warning_correction_periods,
            "the high-risk limit must not be below the warning limit",
        )


@dataclass(frozen=True)
class Exposure:
    clip_luminance: float = 0.98
    overexposed_l50_threshold: float = 0.40
    overexposed_l95_threshold: float = 0.90
    clip_ratio_threshold: float = 0.05
    minimum_consecutive_frames: int = 3
    pixel_stride: int = 1

    def __post_init__(self):
        for name in ("clip_luminance", "overexposed_l50_threshold", "overexposed_l95_threshold", "clip_ratio_threshold"):
            _require(0 <= getattr(self, name) <= 1, f"{name} must lie in [0, 1]")
        _require(self.minimum_consecutive_frames >= 1 and self.pixel_stride >= 1, "frame count and stride start at 1")


@dataclass(frozen=True)
class JointSignal:
    max_step_deg: float
    fallback_max_velocity_deg_s: float
    max_acceleration_deg_s2: float = 5000.0

    def __post_init__(self):
        _require(min(dataclasses.astuple(self)) > 0, "joint limits must be positive")


STATE_SIGNAL = JointSignal(15.0, 300.0)
ACTION_SIGNAL = JointSignal(25.0, 500.0)


@dataclass(frozen=True)
class JointMotion:
    state: JointSignal = STATE_SIGNAL
    action: JointSignal = ACTION_SIGNAL
    velocity_warning_ratio: float = 0.80
    acceleration_warning_ratio: float = 0.80
    position_limit_tolerance_deg: float = 0.10
    spike_min_step_deg: float = 5.0
    spike_recovery_deg: float = 1.0

    def __post_init__(self):
        for name in ("velocity_warning_ratio", "acceleration_warning_ratio"):
            _require(0 < getattr(self, name) <= 1, f"{name} must lie in (0, 1]")
        _require(self.position_limit_tolerance_deg >= 0, "the position tolerance must not be negative")
        _require(self.spike_min_step_deg > 0 and self.spike_recovery_deg >= 0, "spike limits out of range")


@dataclass(frozen=True)
class OperatorConfig:
    exposure: Exposure = field(default_factory=Exposure)
    joint_motion: JointMotion = field(default_factory=JointMotion)


@dataclass(frozen=True)
class SpikeRepair:
    max_step_deg: float = 15.0
    max_velocity_deg_s: float = 300.0
    max_repair_run_frames: int = 6
    max_anchor_delta_deg: float = 15.0
    min_correction_deg: float = 5.0

    def __post_init__(self):
        _require(self.max_step_deg > 0 and self.max_velocity_deg_s > 0, "step and velocity limits must be positive")
        _require(self.max_repair_run_frames >= 1, "max_repair_run_frames must be at least 1")
        _require(self.max_anchor_delta_deg >= 0 and self.min_correction_deg > 0, "correction limits out of range")


def _read(path: str | Path | None) -> dict:
    if path is None:
        return {}
    with open(path, "rb") as handle:
        return tomllib.load(handle)


def load_pipeline_config(path: str | Path | None = None) -> PipelineConfig:
    """Defaults, overridden table by table from a TOML file."""
    data = _read(path)
    quality = data.get("quality", {})
    return PipelineConfig(
        timestamp=TimestampQuality(**quality.get("timestamp", {})),
        cross_stream=CrossStream(**quality.get("cross_stream", {})),
        joint_motion=JointMotionQuality(**quality.get("joint_motion", {})),
        image=ImageQuality(**quality.get("image", {})),
        head_timestamp=HeadTimestamp(**data.get("cleaning", {}).get("head_timestamp", {})),
        conversion=Conversion(**data.get("conversion", {})),
    )


def load_operator_config(path: str | Path | None = None) -> OperatorConfig:
    data = _read(path)
    motion = dict(data.get("joint_motion", {}))
    signals = {
        name: dataclasses.replace(default, **motion.pop(name, {}))
        for name, default in (("state", STATE_SIGNAL), ("action", ACTION_SIGNAL))
    }
    return OperatorConfig(Exposure(**data.get("exposure", {})), JointMotion(**signals, **motion))
