"""Sinks: tables, JDBC databases, keyed stores and Kafka topics."""
