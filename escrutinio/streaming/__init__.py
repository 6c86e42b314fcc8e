"""The bronze / silver / gold lake as Structured Streaming queries."""
