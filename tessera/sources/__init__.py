"""Point readers, writers and result sinks."""
