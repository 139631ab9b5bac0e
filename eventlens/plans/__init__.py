"""Plans: full/incremental runs and the registered query catalogue."""
