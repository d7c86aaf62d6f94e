"""Incremental (streaming) forms of the batch operators."""

from lodestar.streaming.mart_stream import start_mart_stream  # noqa: F401
