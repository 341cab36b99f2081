"""Raw tables, seed tables and sinks."""
