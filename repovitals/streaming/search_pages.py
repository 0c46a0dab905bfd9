"""Search pages as they land: of each id the first item in page order, whenever its page comes.

Pages come in any order and in any number of arrivals. The state of an id is the item that is first by
(page, position) so far, so an item seen in an earlier batch stays unless a page before its own lands.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repovitals.operators.search import repos_from_items
from repovitals.schemas import SEARCH_ITEM
from repovitals.sources.landing import stream_search_pages
from repovitals.sources.store import LayerStore
from repovitals.streaming.kept_states import KeptStates


class SearchPages(KeptStates):
    """The first items of all pages taken so far. packed: see `read_search_pages`."""

    def __init__(self, store: LayerStore, name: str = "search_pages", packed: bool = False):
        super().__init__(store, name)
        self.packed = packed

    def schema(self) -> str:
        place = "struct<page: struct<order: string, path: string>, position: int>"
        return f"id bigint, place {place}, item {SEARCH_ITEM.simpleString()}"

    def stream(self, landed: str) -> DataFrame:
        return stream_search_pages(self.spark, landed, self.packed)

    def reduced(self, batch: DataFrame) -> DataFrame:
        items = batch.select("page", F.posexplode("items").alias("position", "item"))
        placed = items.select(F.col("item.id").alias("id"), F.struct("page", "position").alias("place"), "item")
        return self.merged(placed)

    def merged(self, states: DataFrame) -> DataFrame:
        first = states.groupBy("id").agg(F.min(F.struct("place", "item")).alias("first"))
        return first.select("id", "first.place", "first.item")

    def repositories(self) -> DataFrame:
        """What `repos_from_search` gives for all pages."""
        return repos_from_items(self.states().select("item.*"))
