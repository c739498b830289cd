"""Query plans: fixtures derived from the driver tables, the pipeline jobs, and the query registry."""
