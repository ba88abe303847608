"""Conversation-thread analytics on Spark."""
