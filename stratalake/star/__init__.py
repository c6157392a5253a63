"""The warehouse operators over a plain star schema of orders, line items, parts and people."""
