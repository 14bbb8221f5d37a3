"""Scans: portals, catalogues, datasets, topics, indicators, payloads and fetch."""
