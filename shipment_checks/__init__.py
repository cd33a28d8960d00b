"""Shipment tables derived from the driver's star schema, the queries on them, and their SQL counterparts."""
