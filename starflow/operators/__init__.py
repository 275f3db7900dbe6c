"""Relational operators: loads and upserts, star-schema joins and windows, checks."""
