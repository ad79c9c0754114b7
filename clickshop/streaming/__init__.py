"""The same rules over events that keep arriving."""

from clickshop.streaming.orders import order_stream, scan_event_stream

__all__ = ["order_stream", "scan_event_stream"]
