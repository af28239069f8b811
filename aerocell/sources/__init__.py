"""Payload parsing, table access and archive files."""
