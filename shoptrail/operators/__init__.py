"""Reusable DataFrame operators behind the jobs."""
