"""All registered queries."""

from telemark.plans import frames, joints, streams

QUERIES = {**streams.QUERIES, **joints.QUERIES, **frames.QUERIES}
ORACLES = {**streams.ORACLES, **joints.ORACLES, **frames.ORACLES}
