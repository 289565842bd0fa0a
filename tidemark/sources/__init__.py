"""Readers for lake tables, JDBC tables, streams, manifests and file listings."""
