"""Scans, landing-zone listings, manifests and sinks."""
