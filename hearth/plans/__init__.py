"""The warehouse jobs: bronze, silver, gold, audits, KPIs and reports."""
