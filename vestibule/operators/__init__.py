"""Reusable DataFrame operators; each one returns a plan and none caches."""
