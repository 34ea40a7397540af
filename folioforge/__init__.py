"""Document curation on Spark: paged text in, training tables out."""
