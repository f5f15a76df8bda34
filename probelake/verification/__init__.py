"""Every operator run over the given tables, with the SQL that has to give the same rows."""
