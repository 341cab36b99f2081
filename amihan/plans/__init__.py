"""Gold marts, reports and the daily run."""
