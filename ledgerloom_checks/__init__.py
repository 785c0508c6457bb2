"""Queries over the driver tables and the independent SQL they are checked against."""
