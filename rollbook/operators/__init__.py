"""Table operators: checks, scope, joins, aggregates, schedule engine, cohort, network."""
