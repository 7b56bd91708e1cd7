"""Column-level building blocks: dates, statistics and audit rules."""
