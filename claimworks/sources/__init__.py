"""Scans and sinks: X12 text, FHIR JSON, message topics, versioned Parquet tables."""
