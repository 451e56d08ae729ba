"""Access-log analytics on Spark: Bronze log lines to Silver accesses to Gold scores."""
