"""Streams: the reference has none; see the README."""
