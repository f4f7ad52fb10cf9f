"""Micro-batch delivery: required and optional channels, failover, rolling files."""
