"""The incremental contract as Structured Streaming (STM-*)."""
