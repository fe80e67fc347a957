"""Typed readers and landed-payload explode (SRC-*)."""
