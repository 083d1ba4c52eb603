"""Registered queries with the SQL each is checked against."""
