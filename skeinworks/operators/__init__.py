"""Relational and graph operators over posts."""
