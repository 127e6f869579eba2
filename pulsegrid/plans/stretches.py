"""The queries on detectors again, with every series cut in stretches: the same rows by the same SQL."""

from __future__ import annotations

from functools import partial

from pulsegrid.plans import signals
from pulsegrid.plans.registry import QUERIES, SQL

#: Rows of a stretch: few, so that the tables' series, of about a hundred rows, are cut often.
SIZE = 16

DETECTORS = (
    "saturation_runs",
    "longest_run",
    "flatline",
    "spike_mad",
    "robust_smooth",
    "counter_qc",
    "step_rule",
    "ratio_to_median",
    "temperature_drop",
    "artifact_expand",
    "gap_segments",
    "missing_runs",
    "flat_runs",
    "missing_gaps",
    "label_segments",
)

for name in DETECTORS:
    QUERIES[f"{name}_in_stretches"] = partial(getattr(signals, name), size=SIZE)
    SQL[f"{name}_in_stretches"] = SQL[name]
