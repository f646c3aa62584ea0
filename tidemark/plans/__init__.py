"""Jobs composed of sources, operators and sinks."""
