"""Sources, sinks and control records."""
