"""fleetlake.functions."""
