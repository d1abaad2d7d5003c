"""Landed inputs, tables of state and posts, and their writers."""
