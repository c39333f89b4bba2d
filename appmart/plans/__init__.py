"""Table builders: dimensions, facts, marts, statistics and the full-refresh pipeline."""
