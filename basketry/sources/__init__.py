"""Schemas, readers and named inputs."""
