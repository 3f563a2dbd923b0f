"""The same job over a stream of events."""
