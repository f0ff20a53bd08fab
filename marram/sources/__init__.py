"""Readers under declared schemas, and the tables the jobs write."""
