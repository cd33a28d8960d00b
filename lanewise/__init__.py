"""Reusable Spark operators for shipment analytics and transit-time prediction."""
