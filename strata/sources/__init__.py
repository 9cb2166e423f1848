"""Scans, decoders and table storage."""
