"""Batch analytics written as plain Spark jobs: sources, typed columns, grouped answers, sinks."""
