"""DataFrame-to-DataFrame operators: cleaning, joins, summaries, reports and checks."""
