"""Readers and writers: dumps, staging files, API payloads, driver tables."""
