"""Checkpointed layer jobs."""
