"""The registered queries: feeds built from the given tables, Spark jobs over them, SQL oracles."""
