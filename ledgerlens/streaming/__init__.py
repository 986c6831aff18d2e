"""Structured Streaming jobs."""

from ledgerlens.streaming.confirm_stream import ConfirmTables, run_to_end, start_confirm_stream

__all__ = ["ConfirmTables", "run_to_end", "start_confirm_stream"]
