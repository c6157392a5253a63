"""DataFrame(s) + parameters -> DataFrame; none of these knows a table by name."""
