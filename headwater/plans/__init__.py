"""End-to-end jobs: lineage of all applications, the demo ETL jobs, and the registered queries."""
