"""Governed reads of streams."""
