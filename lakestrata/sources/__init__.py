"""Readers: raw CSV and JSON, layer tables, JDBC tables, file manifests."""
