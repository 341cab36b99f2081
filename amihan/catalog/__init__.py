"""Registered queries: each key with its Spark job and its check in plain SQL."""
