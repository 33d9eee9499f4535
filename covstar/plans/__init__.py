"""End-to-end jobs: load (ETL), refresh, zone build, storage layout."""
