"""Composed workloads, the registered queries with their oracles, and command-line jobs."""
