"""Streaming: intentionally empty.

The catalogue is a batch, full-refresh warehouse: every model is rebuilt
from the raw tables in replace mode and there is no incremental, late-data or
stateful behaviour to reproduce. The package exists so the layout is uniform.
"""
