"""Sources: test-data derivation, extraction, landed payloads and sinks."""
