"""fleetlake.plans."""
