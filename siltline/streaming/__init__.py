"""Streams: wiring of sources, the operators of :mod:`siltline.operators.changes`, and sinks."""
