"""Streams: the log of review decisions."""
