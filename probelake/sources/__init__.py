"""Sources, sinks and the table catalog."""
