"""Operators: each takes and returns frames; nothing is gathered on the driver but bounded reports and lists of policy."""
