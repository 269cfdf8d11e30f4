"""Readers: tables by format, JDBC reference data, change streams."""
