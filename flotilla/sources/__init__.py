"""Inputs and outputs: the positions fixture, Parquet / JSON / text tables, the versioned state store."""
