"""Medallion tables on plain Spark: landing, SCD2 dimensions, gold marts, streams, storage reports."""
