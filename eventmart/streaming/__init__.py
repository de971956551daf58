"""Structured Streaming: stateful rules, sinks, and the jobs that wire topics to them."""
