"""Domain plans: feature stores, scoring, lists and reports."""
