"""Pipelines from configuration files to one lazy plan."""
