"""Relational operators on panels: joins, universe rules, reports, analytics."""
