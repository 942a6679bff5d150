"""Collection schemas, readers and table sinks."""
