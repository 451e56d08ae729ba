"""Column builders: native expressions only, free to combine in any query."""
