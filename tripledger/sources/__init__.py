"""Readers and writers: JSON topic folders, Kafka, keyed Parquet tables."""
