"""tallyweave: unify per-sample genomic tallies, and prepare text corpora, as Spark jobs."""
