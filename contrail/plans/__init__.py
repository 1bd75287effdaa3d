"""Plans: the registered queries, their SQL twins, the batch medallion run
and the table sinks."""
