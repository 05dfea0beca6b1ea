"""Structured Streaming: sources, landing, fraud rules, bursts."""
