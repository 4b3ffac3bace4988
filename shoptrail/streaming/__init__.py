"""The same load as a Structured Streaming job."""
