"""Relational operators: parse / split, union, windowed counts, rollups, queries."""
