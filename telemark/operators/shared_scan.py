"""Quality operators that share one scan of the frames.

An operator says which columns it needs, looks along a stream once (neighbours, runs), and makes its
tables from frames that know what it saw.  The runner reads the columns that any chosen operator
needs and chains the looks.  All of them share keys and order, so Spark plans one scan and one
shuffle for them together.  The frames are then written once, what an operator saw in a column of
its own, and each operator reads only its part.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from typing import Protocol, runtime_checkable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemark.config import ACTION_SIGNAL, Exposure, JointMotion, JointSignal
from telemark.functions.sequence import Track, carry
from telemark.operators import exposure, motion, quality
from telemark.sources.durable import durable


@runtime_checkable
class QualityOperator(Protocol):
    """What the runner asks of an operator."""

    @property
    def columns(self) -> tuple[str, ...]:
        """Columns it reads, beside keys, order and frame number."""

    def look(self, frames: Track, frame: str) -> Track:
        """Add what it needs to know of other frames of the stream."""

    def tables(self, looked: DataFrame, keys: list[str], frame: str, largest: int | None) -> dict[str, DataFrame]:
        """Its results; every table carries the keys.  ``largest`` bounds the rows of one stream."""


OPERATORS: dict[str, Callable[..., QualityOperator]] = {}


def operator(name: str):
    """Register a class of operators under ``name``."""

    def add(made):
        if name in OPERATORS:
            raise ValueError(f"operator {name} is registered already")
        OPERATORS[name] = made
        return made

    return add


def chosen(settings: dict[str, dict]) -> dict[str, QualityOperator]:
    """Operators by registered name, made with their settings."""
    unknown = sorted(set(settings) - set(OPERATORS))
    if unknown or not settings:
        raise ValueError(f"unknown operators {unknown}" if unknown else "no operator was chosen")
    return {name: OPERATORS[name](**options) for name, options in settings.items()}


def needed(operators: dict[str, QualityOperator]) -> list[str]:
    """Columns that at least one operator reads, each once."""
    return list(dict.fromkeys(c for one in operators.values() for c in one.columns))


def _named(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{name}`") for name in names]


def looked_frames(frames: Track, frame: str, operators: dict[str, QualityOperator]) -> DataFrame:
    """The frames with one column per operator of what it saw: one scan, one shuffle."""
    absent = sorted(set(needed(operators)) - set(frames.df.columns))
    if absent:
        raise ValueError(f"frames lack the columns {absent}")
    base = dict.fromkeys([*frames.keys, *frames.segments, *frames.order, frame, *needed(operators)])
    line = replace(frames, df=frames.df.select(*_named(base)))
    for name, one in operators.items():
        before = line.df.columns
        line = one.look(line, frame)
        seen = [c for c in line.df.columns if c not in before]
        line = replace(line, df=line.df.select(*_named(before), F.struct(*_named(seen)).alias(f"_{name}")))
    return line.rows()


def shared_scan(frames: Track, frame: str, operators: dict[str, QualityOperator]) -> dict[str, dict[str, DataFrame]]:
    """Tables of every operator, all from one scan and one shuffle of ``frames``."""
    rows = durable(looked_frames(frames, frame, operators))
    keys, found = list(frames.keys), {}
    for name, one in operators.items():
        own = rows.select(*_named(dict.fromkeys([*keys, *frames.order, frame, *one.columns])), f"_{name}.*")
        found[name] = one.tables(own, keys, frame, frames.largest)
    return found


def _elapsed(later, earlier):
    return later - earlier


@operator("motion")
@dataclass(frozen=True)
class MotionOperator:
    """Joint rules on a vector in radians; ``limits`` has one row a joint."""

    vector: str
    time: str
    limits: DataFrame
    signal: JointSignal = ACTION_SIGNAL
    config: JointMotion = field(default_factory=JointMotion)

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.vector, self.time)

    def look(self, frames: Track, frame: str) -> Track:
        return motion.look_around(frames, self.vector, self.time)

    def tables(self, looked: DataFrame, keys: list[str], frame: str, largest: int | None) -> dict[str, DataFrame]:
        cells = motion.unfolded_cells(looked, keys, self.vector, frame, _elapsed, self.time, radians=True)
        events = motion.motion_events(cells, self.limits, keys, self.signal, self.config)
        return {
            "events": events,
            "status": motion.motion_status(events, looked, keys),
            "joints": motion.joint_distributions(cells, keys, bound=largest),
        }


@operator("action")
@dataclass(frozen=True)
class ActionOperator:
    """Steps of a vector in radians over its first ``joints`` values."""

    vector: str
    limit_deg: float = 25.0
    joints: int = 14

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.vector,)

    def look(self, frames: Track, frame: str) -> Track:
        return carry(frames, prev={"_a1": F.col(f"`{self.vector}`")})

    def tables(self, looked: DataFrame, keys: list[str], frame: str, largest: int | None) -> dict[str, DataFrame]:
        steps = quality.steps_between(looked, keys, self.vector, frame, self.joints)
        return {
            "steps": quality.action_quality(steps, keys, self.limit_deg),
            "largest": quality.largest_jumps(steps, keys),
            "ranges": quality.vector_ranges(looked, keys, [self.vector]),
        }


@operator("exposure")
@dataclass(frozen=True)
class ExposureOperator:
    """Overexposed runs from luminances measured before; ``prefix`` tells cameras of one frame apart."""

    prefix: str = ""
    config: Exposure = field(default_factory=Exposure)

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.prefix + name for name in exposure.METRICS)

    def look(self, frames: Track, frame: str) -> Track:
        line = frames.derive({name: F.col(self.prefix + name) for name in exposure.METRICS} if self.prefix else {})
        return exposure.confirmed_runs(line.derive(exposure.candidate_flags(self.config)), frame, self.config)

    def tables(self, looked: DataFrame, keys: list[str], frame: str, largest: int | None) -> dict[str, DataFrame]:
        return {
            "segments": exposure.exposure_segments(looked, keys, frame),
            "cameras": exposure.exposure_summary(looked, keys, bound=largest),
            "status": exposure.exposure_status(looked, keys),
        }


def verdicts(found: dict[str, dict[str, DataFrame]], keys: Sequence[str]) -> DataFrame:
    """keys, operator and status of all operators that give a status."""
    parts = [t["status"].select(*keys, F.lit(name).alias("operator"), "status") for name, t in found.items() if "status" in t]
    if not parts:
        raise ValueError("no operator gives a status")
    merged = parts[0]
    for more in parts[1:]:
        merged = merged.unionByName(more)
    return merged
