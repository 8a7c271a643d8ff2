"""Landing formats and table sinks."""
