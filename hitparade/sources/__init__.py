"""Readers: landed responses, the raw zone and the lake tables."""
