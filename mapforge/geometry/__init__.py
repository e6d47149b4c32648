"""Planar geometry on plain coordinate lists: codecs, overlay, measures and simplification, without native libraries."""
