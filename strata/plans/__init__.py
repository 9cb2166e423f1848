"""Models: staging, silver facts and dimensions, gold rollups."""
