"""Readers, type inference and panel views."""
