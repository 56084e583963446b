"""Writes. Every write can be repeated: it replaces what an earlier attempt of it left."""
