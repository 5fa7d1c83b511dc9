"""Sources and sinks: table catalog, derived fixture tables, query runner,
keyed lookups and the partitioned mart writer."""
