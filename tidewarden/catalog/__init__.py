"""The registered queries, each over whole tables, and the SQL that gives the same rows."""
