"""Structured Streaming counterparts of the bounded batch runs."""
