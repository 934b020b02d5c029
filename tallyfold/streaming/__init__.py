"""Structured Streaming jobs and their runner."""
