"""Where tables come from: a catalog database, a folder of datasets, a JDBC database."""
