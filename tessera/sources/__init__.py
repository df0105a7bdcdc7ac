"""Readers and writers: fixture tables, delimited and Parquet files, the
prospect table of the reference, the artefact catalogue."""
