"""Jobs composed from sources, operators and sinks."""
