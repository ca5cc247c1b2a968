"""Structured Streaming adapters: the heat map and point-in-box join over a
stream of points against static boxes (the reference itself has no streaming)."""

from planar.streaming.heat import heat_map_stream, point_in_box_stream

__all__ = ["heat_map_stream", "point_in_box_stream"]
