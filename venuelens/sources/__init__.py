"""Readers: files, landing tables, stored payloads and pages, workbooks, JDBC."""
