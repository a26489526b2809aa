"""Clearwell: files in a lake to checked tables and reports, as Spark jobs."""
