"""Declared values (rules, policies, schemas) and the end-to-end governance jobs."""
