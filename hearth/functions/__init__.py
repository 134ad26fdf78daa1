"""Column-level building blocks: cleaning/parsing, calendar attributes, KPI measures."""
