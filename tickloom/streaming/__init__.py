"""Structured Streaming jobs and their batch bodies."""
