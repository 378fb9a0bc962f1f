"""Tidemark: turn raw periodic series into trustworthy serving tables with Spark."""
