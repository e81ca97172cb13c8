from lakestrata.functions.scalars import audit_clock, joined_key, to_millis, zero_if_null

__all__ = ["audit_clock", "joined_key", "to_millis", "zero_if_null"]
