"""Registered queries: each pairs a Spark job with the SQL it must agree with."""
