"""Payload-to-table plans and the registered queries."""
