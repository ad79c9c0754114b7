"""Where events come from and where relations go."""

from clickshop.sources.events import scan_events, write_events
from clickshop.sources.shards import Shards, write_shards
from clickshop.sources.store import Store
from clickshop.sources.trial import events_from_tables, order_lines

__all__ = [
    "Shards",
    "Store",
    "events_from_tables",
    "order_lines",
    "scan_events",
    "write_events",
    "write_shards",
]
