"""Conversation-data curation on Spark DataFrames."""
