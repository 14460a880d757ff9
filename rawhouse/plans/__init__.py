"""Query plans: stand-in warehouses over the driver tables, the registered
queries and their DuckDB oracles, the warehouse build jobs and the analysis
statements over the built tables."""
