"""Table builders, reports and the full refresh, composed of the operators and functions."""
