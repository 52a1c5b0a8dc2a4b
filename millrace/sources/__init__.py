"""Readers: files, databases, landed records, stored web pages."""
