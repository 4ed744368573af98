"""fleetlake.operators."""
