"""fleetlake.streaming."""
