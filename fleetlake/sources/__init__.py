"""fleetlake.sources."""
