"""Training-data operators: dedup, joins, extraction, filtering, mixing and
sharding of a text corpus.  Nothing outside this package imports it; its
queries are added by ``__spark_entry__.py`` when the package is present."""
