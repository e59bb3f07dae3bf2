"""Composite jobs (C1-C11) and the registered query catalogue."""
