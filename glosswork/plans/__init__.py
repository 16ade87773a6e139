"""Whole plans: ingest of a book, the read-only catalogue, and the driver's queries."""
