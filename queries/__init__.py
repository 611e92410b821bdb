"""Registered queries: each pairs a Spark callable with the SQL that checks it."""
