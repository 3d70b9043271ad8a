"""Sources (scans, decoders, ingest checks) and sinks."""
