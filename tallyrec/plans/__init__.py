"""Plans: the daily run graph and the query catalogue."""
