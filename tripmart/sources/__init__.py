"""Readers for the raw, staging and final layers."""
