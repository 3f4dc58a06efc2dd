"""Catalogue scans, manifests and audio."""
