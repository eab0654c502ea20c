"""Readers of archives and service responses, and the link sink."""
