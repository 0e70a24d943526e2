"""Incremental fact loads over a staging directory."""
