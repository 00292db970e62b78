"""Building blocks shared by the jobs: parsing, cell tables, lookups, expansion."""
