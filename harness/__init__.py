"""The library's operators as queries on the driver's tables, each with SQL to check it by."""
