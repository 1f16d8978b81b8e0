"""Structured Streaming forms of index sync, preparation and conversation memory."""
