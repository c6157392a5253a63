"""Layered (raw, clean, star-schema) batch analytics written as Spark DataFrame plans."""
