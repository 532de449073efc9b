"""Acoustic coverage, exposure and gap analytics as Spark jobs."""
