"""Star schema builders, reporting marts and the layer loads."""
