"""Structured Streaming forms: stateful processors and sinks fed by micro-batches."""
