"""Scans: landing files, storage events, ZIP members, CSV text and the lake's own tables."""
