"""Structured Streaming forms of the batch operators: the same results over files or sockets that grow."""
