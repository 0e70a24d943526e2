"""Reports, the full load and the catalogue of named operations."""
