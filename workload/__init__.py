"""The library's plans on the benchmark tables: mapping views, registered queries, checking SQL."""
