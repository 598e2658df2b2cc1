"""Whole tables: refreshing, publishing, auditing, and the standard products."""
