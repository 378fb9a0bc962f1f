"""Streaming path: messages to bronze, silver and gold."""
