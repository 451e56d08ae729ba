"""Log lines derived from the driver's events table, queries over them and their SQL oracles."""
