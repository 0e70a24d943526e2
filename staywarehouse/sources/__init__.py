"""Staging, versioned Parquet tables and the manifest."""
