"""Query plans: the catalogue on the Parquet tables and the reference's
jobs over its own record layouts."""
