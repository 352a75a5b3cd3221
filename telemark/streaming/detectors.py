"""Gap and spike detection on live streams.

The state of a stream is its last one or two frames, whatever the length of the
recording, so results equal the batch operators as long as a stream's messages
arrive in record order.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def _key_ddl(stream: DataFrame, keys: Sequence[str]) -> str:
    return ", ".join(f"`{k}` {stream.schema[k].dataType.simpleString()}" for k in keys)


def detect_gaps(stream: DataFrame, keys: Sequence[str], index: str, time: str, limit_ms: float) -> DataFrame:
    """Steps that are not positive or longer than ``limit_ms``."""
    keys = list(keys)
    output = f"{_key_ddl(stream, keys)}, edge_after_index bigint, step_ns bigint, kind string"

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(index, kind="stable")
        times, places = rows[time].to_numpy(np.int64), rows[index].to_numpy(np.int64)
        if state.exists:
            last_time, last_place = state.get
            times, places = np.insert(times, 0, last_time), np.insert(places, 0, last_place)
        state.update((int(times[-1]), int(places[-1])))
        step = np.diff(times)
        odd = np.flatnonzero((step <= 0) | (step / 1e6 > limit_ms))
        kinds = np.where(step[odd] <= 0, "nonpositive", "gap")
        found = {**{k: [v] * len(odd) for k, v in zip(keys, key, strict=True)}}
        yield pd.DataFrame({**found, "edge_after_index": places[:-1][odd], "step_ns": step[odd], "kind": kinds})

    return (
        stream.select(*keys, index, time)
        .groupBy(*keys)
        .applyInPandasWithState(advance, output, "last_time bigint, last_index bigint", "append", GroupStateTimeout.NoTimeout)
    )


def detect_spikes(
    stream: DataFrame, keys: Sequence[str], frame: str, values: str, *, min_step: float = 5.0, recovery: float = 1.0
) -> DataFrame:
    """Single-frame spikes of joint vectors: out, and back within ``recovery``."""
    keys = list(keys)
    output = f"{_key_ddl(stream, keys)}, frame bigint, joint int, value double, recovery_error double"

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(frame, kind="stable")
        places = list(rows[frame])
        vectors = [np.asarray(v, dtype=np.float64) for v in rows[values]]
        if state.exists:
            old_places, old_vectors = state.get
            places = [*old_places, *places]
            vectors = [*(np.asarray(v) for v in old_vectors), *vectors]
        state.update(([int(p) for p in places[-2:]], [v.tolist() for v in vectors[-2:]]))
        if len(vectors) < 3:
            return
        grid = np.stack(vectors)
        entry, leave = np.abs(grid[1:-1] - grid[:-2]), np.abs(grid[2:] - grid[1:-1])
        back = np.abs(grid[2:] - grid[:-2])
        hits = np.argwhere((entry >= min_step) & (leave >= min_step) & (back <= recovery))
        at, joint = hits[:, 0], hits[:, 1]
        named = {k: [v] * len(hits) for k, v in zip(keys, key, strict=True)}
        found = {
            "frame": np.asarray(places, dtype=np.int64)[at + 1],
            "joint": joint.astype(np.int32),
            "value": np.maximum(entry, leave)[at, joint],
            "recovery_error": back[at, joint],
        }
        yield pd.DataFrame({**named, **found})

    state = "frames array<bigint>, vectors array<array<double>>"
    return (
        stream.select(*keys, frame, values)
        .groupBy(*keys)
        .applyInPandasWithState(advance, output, state, "append", GroupStateTimeout.NoTimeout)
    )
