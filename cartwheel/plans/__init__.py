"""Runs built from operators (end-to-end, timed, format benchmark, generation) and the query registry."""
