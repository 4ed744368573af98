"""fleetlake.sinks."""
