"""Jobs."""
