"""The care-provider warehouse: which tables, which rules, which reports."""
