"""Reading and writing: event JSON, vendor CSV, partitioned tables, Kafka and JDBC."""
