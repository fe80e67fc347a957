"""Composed plans: staging views, marts, the driver-table role mapping and the query catalog."""
