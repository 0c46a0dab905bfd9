"""Event hours, each taken once: a state per (repository, actor) of all hours that landed.

What is read to answer grows with repositories and actors, not with events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from repovitals.operators.activity import actor_states, merged_states, repos_from_states
from repovitals.sources.landing import stream_event_log
from repovitals.sources.store import LayerStore
from repovitals.streaming.kept_states import KeptStates


class EventHours(KeptStates):
    """The states of all hours taken so far."""

    def __init__(self, store: LayerStore, name: str = "event_hours"):
        super().__init__(store, name)

    def schema(self) -> str:
        counts = "push_events bigint, issue_events bigint"
        return f"full_name string, login string, n_events bigint, last_event timestamp_ntz, {counts}"

    def stream(self, landed: str) -> DataFrame:
        return stream_event_log(self.spark, landed)

    def reduced(self, batch: DataFrame) -> DataFrame:
        return actor_states(batch)

    def merged(self, states: DataFrame) -> DataFrame:
        return merged_states(states)

    def repositories(self, as_of: Column) -> DataFrame:
        """What `repos_from_events` gives for the whole log."""
        return repos_from_states(self.states(), as_of)
